"""Small helpers that several operators share."""

from __future__ import annotations

import string
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = string.ascii_uppercase, string.ascii_lowercase


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays as it is."""
    return F.translate(text, UPPER, LOWER)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, sample: int
) -> DataFrame:
    """``label`` and ``text`` of at most ``sample`` labelled ids, those of the least hashes.

    An id gives one row for each of its labels, however many documents share it: the one whose text
    has the least hash. So the bound holds for rows as well, whatever share of them one id has.
    """
    known = labels.filter(F.col(label_column).isNotNull()).select(
        F.col(id_column).alias("__id"), F.col(label_column).cast("int").alias("label")
    )
    chosen = known.distinct().orderBy(F.xxhash64("__id"), "__id", "label").limit(sample)
    named = docs.select(F.col(id_column).alias("__id"), F.col(text_column).alias("text"))
    rows = named.join(F.broadcast(chosen), "__id").groupBy("__id", "label")
    return rows.agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("label", "text")


def fold(id_column: str, count: int) -> Column:
    """Fold of an id: CRC-32 of its decimal text, modulo ``count``; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % count


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        context.addPyFile(str(path))
        _shipped.add(context.applicationId)


def map_batches(df: DataFrame, function: Callable, schema: object) -> DataFrame:
    """``mapInArrow`` with this package's code at hand on every executor."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def map_cogroups(left: DataFrame, by: list[str], right: DataFrame, to: list[str], function: Callable, schema: object) -> DataFrame:
    """``applyInArrow`` on two tables' groups of equal keys, of bounded size, with this package's code at hand."""
    _ship(left.sparkSession)
    return left.groupBy(by).cogroup(right.groupBy(to)).applyInArrow(function, schema)


#: Rows of a small table that may be broadcast.
BROADCAST_ROWS = 1_000_000


def broadcast_within(df: DataFrame) -> DataFrame:
    """A written table of narrow rows, to be broadcast if it has at most ``BROADCAST_ROWS``, else joined as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def map_groups(df: DataFrame, key: str | list[str], function: Callable, schema: object) -> DataFrame:
    """``applyInArrow`` on groups of bounded size, with this package's code at hand."""
    _ship(df.sparkSession)
    return df.groupBy(key).applyInArrow(function, schema)


def column_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of each Arrow batch as Python lists."""
    for batch in batches:
        yield [column.to_pylist() for column in batch.columns]
