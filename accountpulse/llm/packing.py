"""Concatenate and cut: documents as one long run of tokens, cut into sequences of fixed length.

Every document is encoded once, ends in ``END``, and is written with its token count and the running
total of its partition. Prefix sums over the partitions' totals, in two passes (inside bundles of
partitions, then over the bundles), give each document its place in the whole run. From there on
everything is arithmetic in built-in expressions: a document's pieces are the fixed windows that its
range touches, and where a window's edge cuts it, two rows meet. No row is shuffled.

All windows but the last are full. The rest of the run is cut at the powers of two that add up
to it, so no sequence needs any padding where powers of two are allowed as lengths.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage
from .bpe import _packed, byte_alphabet
from .common import broadcast_within, map_batches

#: Tokens of a sequence, and the id that ends a document.
SIZE, END = 2048, 1
#: Partitions whose totals are summed by one task of the first pass.
BUNDLE = 1024
#: A space between two other characters that are no white space always begins a word of the vocabulary's own.
SPACE = re.compile(r"(?<=\S)(?= \S)")

# --- Fixed values -----------------------------------------------------------
# Words of a byte-level vocabulary.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ----------------------------------------------------------------------------


# --- Tokens -----------------------------------------------------------------


def merger(tokenizer: object) -> Callable[[str], list[int]] | None:
    """A faster encoder of Latin-1 text than the library's, if it provably gives the same ids, else None.

    The library joins a pair that its merge list names, earliest entry first; ``tiktoken`` joins any two
    neighbours that make a token, lowest id first. These are the same steps if ids ascend along the
    merge list and the library turns each token's own bytes into just that token: were two other
    neighbours ever to make the token, they would do so from its bytes alone as well. Both split words
    by the same pattern, whose classes are settled for Latin-1 in every version of Unicode.
    """
    stated = json.loads(tokenizer.to_str())
    model, split = stated["model"], stated["pre_tokenizer"] or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    if not plain or stated["normalizer"] or model["type"] != "BPE":
        return None
    order = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    whole = all([t.id for t in tokenizer.model.tokenize(token)] == [i] for token, i in model["vocab"].items())
    byte_of = {c: b for b, c in enumerate(byte_alphabet())}
    if not whole or order != sorted(order) or len(order) + len(byte_of) != len(model["vocab"]):
        return None
    import tiktoken

    ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items()}
    return tiktoken.Encoding("words", pat_str=WORD, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit integers, as the tokenizers library gives them.

    A text in Latin-1 without special tokens goes through ``merger``. Any other is cut at spaces where
    the vocabulary starts a word anyway (a special token holds none), and those of its parts that need it
    go to the library.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.merged = merger(self.tokenizer)

    def simple(self, text: str) -> bool:
        if any(token in text for token in self.special):
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return True

    def _library(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def ids(self, text: str) -> bytes:
        if self.merged is None:
            return self._library(text)
        if self.simple(text):
            return _packed(self.merged(text))
        runs = [(simple, "".join(parts)) for simple, parts in groupby(SPACE.split(text), key=self.simple)]
        return b"".join(_packed(self.merged(run)) if simple else self._library(run) for simple, run in runs)


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder per worker and vocabulary."""
    return Encoder(vocabulary)


def _tokenised(vocabulary: str, end: int):
    closing = struct.pack("<I", end)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, before = encoder(vocabulary), 0
        for batch in batches:
            # A few texts at a time, so that ids of long ones don't pile up.
            for at in range(0, len(batch), 256):
                rows = batch.slice(at, 256)
                ids = [codes.ids(text or "") + closing for text in rows.column(1).to_pylist()]
                sizes = [len(i) // 4 for i in ids]
                starts = []
                for size in sizes:
                    starts.append(before)
                    before += size
                columns = [rows.column(0), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(starts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "ids", "n", "before"])

    return encode


def tokenised(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", end: int = END) -> DataFrame:
    """Written table of ``key``, ``ids``, their number ``n``, the partition ``part`` and ``before``, the tokens before in it."""
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = slim.schema["key"].dataType.simpleString()
    rows = map_batches(slim, _tokenised(vocabulary, end), f"key {kind}, ids binary, n long, before long")
    return stage(rows.withColumn("part", F.spark_partition_id()), "tokens")


# --- Places -----------------------------------------------------------------


def part_shifts(tokens: DataFrame) -> DataFrame:
    """Per partition the tokens of all partitions before it, by prefix sums inside bundles and over bundles."""
    bundle = F.expr(f"part div {BUNDLE}")
    totals = stage(tokens.groupBy("part").agg(F.sum("n").alias("n")).withColumn("bundle", bundle), "totals")
    earlier = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy("bundle").orderBy("part").rowsBetween(*earlier)
    over = Window.partitionBy(F.lit(0)).orderBy("bundle").rowsBetween(*earlier)
    bundles = totals.groupBy("bundle").agg(F.sum("n").alias("n"))
    shifts = bundles.select("bundle", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    parts = totals.select("part", "bundle", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("within"))
    return parts.join(shifts, "bundle").select("part", (F.col("base") + F.col("within")).alias("shift"))


def rest_edges(rest: int) -> list[int]:
    """Edges that cut ``rest`` tokens at the powers of two it consists of, largest first."""
    edges = [0]
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            edges.append(edges[-1] + (1 << bit))
    return edges


class Windows:
    """Sequences of a run of ``total`` tokens: full ones of ``size``, then the rest in powers of two."""

    def __init__(self, total: int, size: int) -> None:
        self.full, self.size = total // size, size
        edges = rest_edges(total % size)
        self.edges = F.array(*[F.lit(self.full * size + e).cast("long") for e in edges])

    def number(self, place: Column) -> Column:
        """Sequence that holds a token of the run."""
        rest = self.full - 1 + F.size(F.filter(self.edges, lambda e: e <= place))
        return F.when(place < self.full * self.size, F.floor(place / self.size)).otherwise(rest).cast("long")

    def start(self, number: Column) -> Column:
        """First token of a sequence; one behind the last sequence, the run's end."""
        rest = F.try_element_at(self.edges, (number - self.full + 1).cast("int"))
        return F.when(number < self.full, number * self.size).otherwise(rest)


def packed(
    docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = END, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Pieces of all documents: ``key``, ``start``, ``length``, ``ids``, ``doc_tokens``, ``sequence_id``, ``offset``.

    ``ids`` are little-endian unsigned 32-bit integers. A document's tokens, ``end`` included, lie in
    consecutive pieces in their order; ``start`` counts its tokens before a piece. Sequences are numbered
    from 0 and filled from offset 0 without gaps. Null and empty texts are the one token ``end``. Rows
    are documents, so repeated rows or ids are packed as often as they occur. An empty table has no
    pieces. Other columns don't travel, whatever their names.
    """
    tokens = tokenised(docs, vocabulary, key, text, end)
    total = tokens.agg(F.sum("n")).first()[0] or 0
    windows = Windows(total, size)
    # A row per partition of the tokens.
    shifts = broadcast_within(stage(part_shifts(tokens), "shifts"))
    rows = tokens.join(shifts, "part").select("key", "ids", "n", (F.col("before") + F.col("shift")).alias("first"))
    first, behind = F.col("first"), F.col("first") + F.col("n")

    def piece(number: Column) -> Column:
        low, high = F.greatest(windows.start(number), first), F.least(windows.start(number + 1), behind)
        at, length = low - first, high - low
        return F.struct(
            at.alias("start"),
            length.alias("length"),
            F.substring(F.col("ids"), (at * 4 + 1).cast("int"), (length * 4).cast("int")).alias("ids"),
            number.alias("sequence_id"),
            (low - windows.start(number)).alias("offset"),
        )

    pieces = F.transform(F.sequence(windows.number(first), windows.number(behind - 1)), piece)
    cut = rows.select(F.col("key").alias(key), F.col("n").alias("doc_tokens"), F.inline(pieces))
    return cut.select(key, "start", "length", "ids", "doc_tokens", "sequence_id", "offset")


def sequences(pieces: DataFrame) -> DataFrame:
    """The sequences themselves: ``sequence_id``, ``ids`` and ``n_tokens``. A sequence has at most as many pieces as tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b"").cast("binary"), lambda ids, p: F.concat(ids, p["ids"]))
    grouped = pieces.groupBy("sequence_id").agg(joined.alias("ids"))
    return grouped.withColumn("n_tokens", F.expr("octet_length(ids) div 4"))
