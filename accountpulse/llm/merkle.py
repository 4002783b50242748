"""A Merkle manifest of a table: postorder append logs by aligned builders, and proofs from them.

Every row is a leaf, the digest of its named columns. Leaves of a group (a language) are ranked by a
range shuffle, and runs of ``ARITY`` nodes become their digest, level by level, until one node stays:
the group's subroot. Subroots, ordered by group, become the root in the same way.

Ranks are cut into aligned blocks of ``ARITY ** DEPTH`` leaves. A builder takes one block and
appends its nodes to a log in the order they are complete, which is postorder: a run's parent follows
its last child at once. The blocks' top nodes are the leaves of the next band, so a tree of n leaves
has ``log(n) / (DEPTH log(ARITY))`` bands, and no task ever holds more than a block however large a
group is. A node's place in the log follows in closed form from the sizes of the subtrees before it
(``place``), so proofs address siblings without a search: each block looks its own levels up, and
gets the levels above from the band above by one join on the block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import broadcast_within, map_batches, map_cogroups, map_groups

#: Children of a node.
ARITY = 8
#: Levels that one builder adds: its block has ``ARITY ** DEPTH`` leaves.
DEPTH = 3
BLOCK = ARITY**DEPTH
#: Length of a digest in bytes, and of its hexadecimal text.
RAW, HEX = 32, 64
#: Columns of ``documents`` that a leaf covers, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before: string, after: string>>"


# --- Leaves -----------------------------------------------------------------


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of a record: per field its length in UTF-8 bytes, a colon and its text, or ``-`` for null."""
    texts = [field.cast("string") for field in fields]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows with their ``rank`` in ``group``, from 0, and the group's ``size``.

    One range shuffle by group and order deals a group of any size evenly; the rows' places in their
    partition and the partitions' totals per group give the ranks. Rows that are equal in all of
    ``order`` may be swapped, which a last unique number makes possible without one task for all.
    """
    numbered = stage(rows.withColumn("__tie", F.monotonically_increasing_id()), "leaves")
    by = [F.col(c).asc_nulls_first() for c in ("group", *order, "__tie")]
    dealt = numbered.repartitionByRange(*by).sortWithinPartitions(*by).drop("__tie")
    placed = stage(dealt.withColumn("__place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("__place", 33)
    runs = placed.groupBy("group", part.alias("__part")).agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    whole = Window.partitionBy("group")
    before = F.sum("__n").over(whole.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        F.col("group"),
        "__part",
        (F.coalesce(before, F.lit(0)) - F.col("__first")).alias("__shift"),
        F.sum("__n").over(whole).alias("size"),
    )
    # A run is a partition's share of a group: at most as many as partitions and groups together.
    joined = placed.withColumn("__part", part).join(broadcast_within(stage(runs, "runs")), ["group", "__part"])
    return joined.withColumn("rank", F.col("__place") + F.col("__shift")).drop("__part", "__place", "__shift")


# --- Shape of a tree --------------------------------------------------------


def counts(leaves: int) -> list[int]:
    """Number of nodes per level, from the leaves to the single top node."""
    levels = [leaves]
    while levels[-1] > 1:
        levels.append(-(-levels[-1] // ARITY))
    return levels


def place(level: int, index: np.ndarray | int, leaves: int, height: int) -> np.ndarray | int:
    """Postorder place, from 0, of a level's nodes in a tree of ``leaves`` and ``height`` levels above them.

    Complete with or before the node are, on its own and lower levels, the nodes that start before its
    subtree's end, and on higher levels those that end where the subtree starts.
    """
    start = np.asarray(index) * ARITY**level
    end = np.minimum(start + ARITY**level, leaves)
    within = sum(-(-end // ARITY**j) for j in range(level + 1))
    return within + sum(start // ARITY**j for j in range(level + 1, height + 1)) - 1


def block_height(size: int) -> int:
    """Levels that each block of a tree adds: its whole band's, unless the tree ends below."""
    return min(DEPTH, len(counts(size)) - 1)


def parent(children: Sequence[bytes]) -> bytes:
    """Digest of a run of nodes, as hexadecimal text."""
    return sha256(b"".join(children)).hexdigest().encode()


class Builder:
    """Appends the nodes of one block in the order they are complete."""

    def __init__(self) -> None:
        self.log: list[bytes] = []
        self.open: list[list[bytes]] = [[] for _ in range(DEPTH + 1)]

    def add(self, node: bytes, level: int = 0) -> None:
        self.log.append(node)
        self.open[level].append(node)
        if len(self.open[level]) == ARITY:
            self.close(level)

    def close(self, level: int) -> None:
        children, self.open[level] = self.open[level], []
        self.add(parent(children), level + 1)

    def finish(self, height: int) -> list[bytes]:
        """The log, with the runs that are still open closed up to ``height``."""
        for level in range(height):
            if self.open[level]:
                self.close(level)
        return self.log


# --- Logs -------------------------------------------------------------------


def _segments(names: Sequence[str]):
    """Function that builds the log of one block; ``names`` are columns that travel with the leaves."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        builder = Builder()
        for node in table["node"].to_pylist():
            builder.add(node.hex().encode())
        size = table["size"][0].as_py()
        log = builder.finish(block_height(size))
        rows = len(table)
        one = {
            "group": table["group"].slice(0, 1),
            "block": table["block"].slice(0, 1),
            "size": table["size"].slice(0, 1),
            "members": pa.array([rows], pa.int64()),
            "nodes": pa.array([b"".join(map(bytes.fromhex, (n.decode() for n in log)))], pa.binary()),
        }
        carried = {c: pa.ListArray.from_arrays(pa.array([0, rows], pa.int32()), table[c].combine_chunks()) for c in names}
        return pa.table({**one, **carried})

    return build


def _bands(rows: DataFrame, names: Sequence[str], largest: int) -> list[DataFrame]:
    """Logs of all trees, a table per band; each row is one block's segment in completion order."""
    spark, bands = rows.sparkSession, []
    while True:
        types = {f.name: f.dataType.simpleString() for f in rows.schema}
        lists = "".join(f", `{c}` array<{types[c]}>" for c in names)
        schema = "group string, block long, size long, members long, nodes binary" + lists
        dealt = rows.withColumn("block", F.expr(f"rank div {BLOCK}"))
        bands.append(stage(map_groups(dealt, ["group", "block"], _segments(names), schema), "log"))
        if largest <= BLOCK:
            return bands
        top = F.substring("nodes", -RAW, RAW)
        rows = bands[-1].select("group", F.col("block").alias("rank"), F.expr(f"(size + {BLOCK - 1}) div {BLOCK}").alias("size"), top.alias("node"))
        names, largest = (), -(-largest // BLOCK)


def _trees(leaves: DataFrame, order: Sequence[str], names: Sequence[str]) -> list[DataFrame]:
    rows = stage(ranked(leaves, order), "tree")
    return _bands(rows, names, rows.agg(F.max("size")).first()[0] or 0)


@dataclass(frozen=True)
class Manifest:
    """Written logs: ``groups`` has the bands of the groups' trees, ``top`` those of the tree of subroots.

    A row is a segment: ``group``, ``block``, ``size`` (leaves of its tree in this band), ``members``
    (leaves of the block), ``nodes`` (digests in completion order, 32 bytes each). The lowest bands
    also carry their leaves' own columns as lists.
    """

    groups: list[DataFrame]
    top: list[DataFrame]
    carried: tuple[str, ...]

    def root(self) -> str | None:
        """The manifest's root in hexadecimal; None for an empty table."""
        last = self.top[-1].select(F.lower(F.hex(F.substring("nodes", -RAW, RAW))).alias("root")).first()
        return last and last["root"]


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    altered: Column | None = None,
) -> Manifest:
    """Logs of the Merkle trees over every row of ``docs``.

    Rows are ordered within their group by ``order`` (nulls first) and then by their leaf, so repeated
    rows are leaves side by side, and repeated ids have one defined order. A null group is a group
    of its own and comes first. Null fields are ``-``, an empty text is ``0:``. An empty table has no
    nodes and no root. Columns beyond ``fields`` aren't covered and don't travel, whatever their
    names. ``altered`` is a second leaf digest to be carried beside the right one, for checks.
    """
    # Group texts start with "-" (null) or ":", so their bytewise order has null first.
    leaves = docs.select(
        F.coalesce(F.concat(F.lit(":"), F.col(group).cast("string")), F.lit("-")).alias("group"),
        F.col(order).alias("key"),
        leaf_digest([F.col(c) for c in fields]).alias("node"),
        (F.lit(None).cast("binary") if altered is None else altered).alias("altered"),
    )
    groups = _trees(leaves, ("key", "node"), ("key", "altered"))
    subroots = groups[-1].select(
        F.lit("").alias("group"), F.col("group").alias("key"), F.substring("nodes", -RAW, RAW).alias("node")
    )
    return Manifest(groups, _trees(subroots, ("key",), ("key",)), ("key", "altered"))


def log_nodes(bands: Sequence[DataFrame]) -> DataFrame:
    """Every node of the bands' trees once, with its ``level``, ``index`` and ``position`` in its tree's log."""

    def spread(band: int):
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in (batch.slice(i, 1).to_pylist()[0] for i in range(len(batch))):
                    height, first = block_height(row["size"]), row["block"] * BLOCK
                    for level, count in enumerate(_levels(row["members"], height)):
                        if band and not level:
                            continue
                        index = np.arange(count)
                        at = place(level, index, row["members"], height)
                        yield pa.record_batch(
                            {
                                "group": [row["group"]] * count,
                                "level": pa.array([band * DEPTH + level] * count, pa.int32()),
                                "index": index + first // ARITY**level,
                                "node": [row["nodes"][RAW * p : RAW * p + RAW] for p in at],
                            }
                        )

        return listed

    schema = "group string, level int, index long, node binary"
    columns = ("group", "block", "size", "members", "nodes")
    nodes = reduce(DataFrame.unionByName, (map_batches(seg.select(*columns), spread(i), schema) for i, seg in enumerate(bands)))
    sizes = bands[0].where("block = 0").select("group", "size")
    return nodes.join(sizes, "group").withColumn("position", _position(F.col("level"), F.col("index"), F.col("size")))


def _position(level: Column, index: Column, size: Column) -> Column:
    """``place`` as an expression, for trees of up to ``ARITY ** 20`` leaves."""
    powers = F.array(*[F.lit(ARITY**j).cast("long") for j in range(21)])
    width = F.element_at(powers, level + 1)
    start = index * width
    end = F.least(start + width, size)
    # On a level above the top node, nothing ends before the start.
    own = F.aggregate(F.slice(powers, 1, level + 1), F.lit(0).cast("long"), lambda n, w: n + F.floor((end + w - 1) / w))
    above = F.aggregate(F.slice(powers, level + 2, 21), F.lit(0).cast("long"), lambda n, w: n + F.floor(start / w))
    return own + above - 1


# --- Proofs -----------------------------------------------------------------


def _levels(members: int, height: int) -> list[int]:
    """Nodes per level of a block, with a level for every one that the tree still has there."""
    levels = [members]
    for _ in range(height):
        levels.append(-(-levels[-1] // ARITY))
    return levels


def _paths(names: Sequence[str]):
    """Function that gives each leaf of a block its siblings: the block's own, then those above it."""

    def extract(segment: pa.Table, above: pa.Table) -> pa.Table:
        row = {c: segment[c][0].as_py() for c in ("group", "block", "size", "members", "nodes")}
        members, height = row["members"], block_height(row["size"])
        text = row["nodes"].hex()
        runs = []
        for level, count in enumerate(_levels(members, height)[:height]):
            at = place(level, np.arange(count), members, height)
            digests = [text[HEX * p : HEX * p + HEX] for p in at]
            runs.append(["".join(digests[i : i + ARITY]) for i in range(0, count, ARITY)])
        rest = above["path"][0].as_py()
        upper = [s["before"] for s in rest], [s["after"] for s in rest]
        before, after = [], []
        for i in range(members):
            for run in runs:
                i, q = divmod(i, ARITY)
                before.append(run[i][: HEX * q])
                after.append(run[i][HEX * q + HEX :])
            before += upper[0]
            after += upper[1]
        steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], ["before", "after"])
        offsets = pa.array(np.arange(members + 1, dtype=np.int32) * (height + len(rest)))
        leaves = place(0, np.arange(members), members, height)
        raw = row["nodes"]
        out = {
            "group": pa.array([row["group"]] * members, pa.string()),
            "rank": pa.array(np.arange(members) + row["block"] * BLOCK),
            "node": pa.array([raw[RAW * p : RAW * p + RAW] for p in leaves], pa.binary()),
            "path": pa.ListArray.from_arrays(offsets, steps),
            "roots": pa.array([above["roots"][0].as_py()] * members, pa.list_(pa.string())),
        }
        return pa.table(out | {c: segment[c].combine_chunks().flatten() for c in names})

    return extract


def _down(bands: Sequence[DataFrame], above: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Paths of the lowest band's leaves. ``above`` has a path and the roots for each tree's top node."""
    for band in reversed(range(len(bands))):
        names = [c for c in carried if c in bands[band].columns]
        types = {f.name: f.dataType.elementType.simpleString() for f in bands[band].schema if f.name in names}
        schema = f"group string, rank long, node binary, path {PATH}, roots array<string>"
        schema += "".join(f", `{c}` {types[c]}" for c in names)
        above = map_cogroups(bands[band], ["group", "block"], above, ["group", "rank"], _paths(names), schema)
        if band:
            above = stage(above.select("group", "rank", "path", "roots"), "paths")
    return above


def proofs(built: Manifest) -> DataFrame:
    """Per leaf its ``key``, ``altered``, ``leaf``, ``subroot`` and ``root`` (hexadecimal) and its ``path``.

    ``path`` lists, from the leaf's level up to the root's, the digests of its siblings before and
    after it, joined as text; a level where it has none holds two empty texts.
    """
    last = built.top[-1]
    root = F.lower(F.hex(F.substring("nodes", -RAW, RAW)))
    start = last.select("group", F.col("block").alias("rank"), F.array().cast(PATH).alias("path"), F.array(root).alias("roots"))
    tops = _down(built.top, start, ("key",))
    # A subroot's path is the path above the one node that its group's last band ends in.
    above = tops.select(
        F.col("key").alias("group"),
        F.lit(0).cast("long").alias("rank"),
        "path",
        F.concat(F.array(F.lower(F.hex("node"))), "roots").alias("roots"),
    )
    found = _down(built.groups, above, built.carried)
    return found.select(
        "key",
        F.lower(F.hex("altered")).alias("altered"),
        F.lower(F.hex("node")).alias("leaf"),
        F.col("roots")[0].alias("subroot"),
        F.col("roots")[1].alias("root"),
        "path",
    )


def folded(leaf: Column, path: Column) -> Column:
    """Root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, step: F.sha2(F.concat(step["before"], node, step["after"]), 256))


def path_digest(path: Column) -> Column:
    """Digest of a path's siblings, from the leaf's level to the root's, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""), 256)
