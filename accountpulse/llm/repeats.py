"""Repeated byte strings across documents, by suffix arrays of shards.

Every byte covered by a string of ``SPAN`` bytes that also starts anywhere else is marked.

1. Equal texts are one text; where two rows share it, all of it repeats.
2. Winnowing picks an anchor in each window of ``SPAN`` bytes: the place of the least gram hash.
   Equal windows have equal anchors, so a window can only repeat if its anchor's hash occurs twice.
   Counting the hashes leaves the few regions that may repeat.
3. Windows that follow each other and share an anchor are one segment. Equal segments are counted
   before they meet, so a passage in a third of all documents is one row per task. Segments are
   dealt out by their anchor's hash, which brings equal windows to the same task.
4. A task cuts its segments into shards of bounded size. Each shard's suffix array is sorted by
   Larsson-Sadakane refinement, Kasai's rule gives common prefixes, and windows whose common prefix
   with a neighbour reaches ``SPAN`` repeat. An anchor whose segments fill several shards has
   its shards merged: the windows of one are looked up in the others' arrays by binary search.
5. An anchor with more segments than one task may hold is passed on by a stream and its windows are
   counted by digest across the cluster.
6. Marked runs go back to each text by its segments.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import column_lists, map_batches, width
from .suffixes import kasai, packed, search, suffix_array, words_at

#: Bytes of a string that counts as a repeat; a multiple of eight.
SPAN = 200
#: Bytes of the grams that anchors are chosen among.
GRAM = 24
#: Bytes of segments in a shard.
SHARD = 2 << 20
#: Bytes of one anchor's segments that a task holds; more are counted across the cluster.
GROUP = 16 << 20
#: Windows in a segment, at most; a longer run of one anchor is cut.
LONGEST = 1 << 16

ODD = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray, times: int) -> np.ndarray:
    x = x * np.uint64(times)
    return x ^ (x >> np.uint64(29))


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes at each place where so many are left; ``size`` is a multiple of eight."""
    words = packed(data)
    out = np.full(len(data) - size + 1, size, np.uint64)
    for at in range(0, size, 8):
        out = _mixed(out ^ _mixed(words[at : at + len(out)], ODD[0]), ODD[1])
    return out


def least_in_windows(values: np.ndarray, size: int) -> np.ndarray:
    """Least value of each ``size`` neighbours, by doubling."""
    known = 1
    while known * 2 <= size:
        values = np.minimum(values[: len(values) - known], values[known:])
        known *= 2
    rest = size - known
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def window_hashes(data: bytes, span: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor hash of each window of ``span`` bytes and hash of each gram; none where the text is shorter."""
    if len(data) < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    grams = gram_hashes(np.frombuffer(data, np.uint8), gram)
    return least_in_windows(grams, span - gram + 1), grams


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _cuts(least: np.ndarray) -> np.ndarray:
    """Where runs of one anchor hash begin, and the end; long runs are cut."""
    fresh = np.concatenate(([True], least[1:] != least[:-1]))
    begins = np.flatnonzero(fresh) if len(least) else np.zeros(0, np.int64)
    ends = np.append(begins[1:], len(least))
    pieces = [np.arange(b, e, LONGEST) for b, e in zip(begins, ends) if e - b > LONGEST]
    return np.unique(np.concatenate([begins, [len(least)], *pieces]).astype(np.int64))


def _anchors(least: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Anchor hashes of one text; those of a gram that comes at more than one place are there twice."""
    if not len(least):
        return np.zeros(0, np.int64)
    different = np.unique(least[_cuts(least)[:-1]])
    at = np.minimum(np.searchsorted(different, grams), len(different) - 1)
    times = np.bincount(at[different[at] == grams], minlength=len(different))
    return np.concatenate((different, different[times > 1])).view(np.int64)


def _row_facts(span: int, gram: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys, hashes = [], [], [], []
            for text in batch.column(1).to_pylist():
                data = _bytes(text)
                digest = sha256(data)
                sizes.append(len(data))
                digests.append(digest.hexdigest())
                keys.append(digest.digest()[:16])
                hashes.append(_anchors(*window_hashes(data, span, gram)))
            lists = pa.ListArray.from_arrays(
                np.concatenate(([0], np.cumsum([len(h) for h in hashes]))).astype(np.int32), np.concatenate(hashes)
            )
            columns = [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests), lists]
            yield pa.RecordBatch.from_arrays(columns, ["id", "key", "n_bytes", "sha256", "hashes"])

    return run


def _segments(span: int, gram: int) -> Callable:
    """Segments of each text whose anchor hash is among those that repeat."""
    kinds = {"key": pa.binary(), "start": pa.int32(), "hash": pa.int64(), "digest": pa.binary(), "body": pa.binary()}

    def packed_rows(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], [*kinds])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, texts, wanted in column_lists(batches):
            rows: list[tuple] = []
            held = 0
            for key, text, known in zip(keys, texts, wanted):
                data = _bytes(text)
                least, _ = window_hashes(data, span, gram)
                cuts = _cuts(least)
                own = least[cuts[:-1]].view(np.int64)
                for i in np.flatnonzero(np.isin(own, np.array(known, np.int64))):
                    body = data[cuts[i] : cuts[i + 1] - 1 + span]
                    rows.append((key, int(cuts[i]), int(own[i]), blake2b(body, digest_size=16).digest(), body))
                    held += len(body)
                if held > SHARD:
                    yield packed_rows(rows)
                    rows, held = [], 0
            if rows:
                yield packed_rows(rows)

    return run


class Shard:
    """Windows of some segments in the order of their text, and which of them repeat."""

    def __init__(self, bodies: list[bytes], repeated: list[bool], span: int):
        self.span = span
        data = np.frombuffer(b"".join(bodies), np.uint8)
        sizes = np.array([len(b) for b in bodies], np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)
        self.windows = sizes - span + 1
        self.keys = packed(data)
        segment = np.repeat(np.arange(len(bodies)), self.windows)
        first = np.concatenate(([0], np.cumsum(self.windows)[:-1])).astype(np.int64)
        places = self.starts[segment] + np.arange(len(segment)) - first[segment]
        known = np.full(len(data), -1, np.int64)
        known[places] = segment
        order = suffix_array(data)
        self.order = order[known[order] >= 0]
        self.segment = known[self.order]
        common = kasai(self.keys, self.order, self.starts, self.windows, span)
        self.kind = np.cumsum(common < span) - 1  # number of the different window, in order
        twice = np.bincount(self.kind) > 1
        twice[self.kind[np.array(repeated, bool)[self.segment]]] = True
        self.twice = twice
        self.first = np.flatnonzero(common < span)  # where each kind begins

    def merge(self, other: Shard, chunk: int = 20_000) -> None:
        """Mark the windows that both shards have, by binary search of the other's in this one."""
        mine, theirs = self.order[self.first], other.order[other.first]
        for a, b in ((self, other), (other, self)):
            places, inside = (theirs, mine) if a is self else (mine, theirs)
            for at in range(0, len(places), chunk):
                wanted = words_at(b.keys, places[at : at + chunk], self.span)
                b.twice[at : at + chunk] |= search(a.keys, inside, wanted, self.span)

    def runs(self) -> list[list[int]]:
        """Of each segment, the marked runs as begin, end, begin, end, ..."""
        place = np.sort(self.order[self.twice[self.kind]])
        return runs_by_segment(place, self.starts, self.span)


def runs_by_segment(places: np.ndarray, starts: np.ndarray, span: int) -> list[list[int]]:
    """Union of the spans at sorted ``places``, in the segments that begin at ``starts``."""
    out: list[list[int]] = [[] for _ in starts]
    if len(places):
        segment = np.searchsorted(starts, places, "right") - 1
        fresh = np.concatenate(([True], (segment[1:] != segment[:-1]) | (places[1:] > places[:-1] + span)))
        begins = np.flatnonzero(fresh)
        ends = np.concatenate((begins[1:], [len(places)])) - 1
        for b, e in zip(begins, ends):
            s = segment[b]
            out[s] += [int(places[b] - starts[s]), int(places[e] - starts[s] + span)]
    return out


MARKS = "again boolean, digest binary, runs array<int>, body binary"


def _marks_of_sorted(span: int, shard: int, group: int) -> Callable:
    """Rows sorted by anchor hash to marked runs; of anchors beyond ``group`` bytes, the rows themselves."""

    def batch(again: bool, rows: list[tuple]) -> pa.RecordBatch:
        digests, runs, bodies = zip(*rows)
        kinds = (pa.bool_(), pa.binary(), pa.list_(pa.int32()), pa.binary())
        columns = ([again] * len(rows), digests, runs, bodies)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["again", "digest", "runs", "body"])

    def marked(shards: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        built = [Shard([r[2] for r in rows], [r[3] for r in rows], span) for rows in shards]
        for i, one in enumerate(built):
            for two in built[i + 1 :]:
                one.merge(two)
        for rows, one in zip(shards, built):
            out = [(row[1], runs, None) for row, runs in zip(rows, one.runs()) if runs]
            if out:
                yield batch(False, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared: list[tuple] = []  # whole anchors, waiting to fill a shard
        shared_size = 0
        own: list[list[tuple]] = [[]]  # shards of the anchor that is being read
        own_size, last, passing = 0, None, False

        def passed(rows: list[tuple]) -> pa.RecordBatch:
            return batch(True, [(r[1], [0, len(r[2])] if r[3] else None, r[2]) for r in rows])

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal shared, shared_size, own, own_size, passing
            if passing:
                if own[0]:
                    yield passed(own[0])
            elif len(own) > 1:
                yield from marked(own)
            elif own[0]:
                shared += own[0]
                shared_size += own_size
                if shared_size > shard:
                    yield from marked([shared])
                    shared, shared_size = [], 0
            own, own_size, passing = [[]], 0, False

        for hashes, digests, bodies, repeated in column_lists(batches):
            for row in zip(hashes, digests, bodies, repeated):
                if row[0] != last:
                    yield from closed()
                    last = row[0]
                if passing:
                    own[0].append(row)
                    if len(own[0]) >= 1000:
                        yield passed(own[0])
                        own = [[]]
                    continue
                if own[-1] and own_size >= shard * len(own):
                    own.append([])
                own[-1].append(row)
                own_size += len(row[2])
                if own_size > group:
                    yield from map(passed, own)
                    own, passing = [[]], True
            if passing and own[0]:
                yield passed(own[0])
                own = [[]]
        yield from closed()
        if shared:
            yield from marked([shared])

    return run


def _counted_across(rows: DataFrame, span: int) -> DataFrame:
    """``digest``, ``runs`` of the segments of very frequent anchors, by counting window digests."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for digests, bodies, runs in column_lists(batches):
            for digest, body, whole in zip(digests, bodies, runs):
                n = len(body) - span + 1
                seen = [blake2b(body[i : i + span], digest_size=16).digest() for i in range(n)]
                columns = [pa.array(seen, pa.binary()), pa.array([digest] * n, pa.binary()), pa.array(range(n), pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([2 if whole else 1] * n, pa.int32())], ["window", "digest", "start", "times"])

    found = map_batches(rows.select("digest", "body", "runs"), windows, "window binary, digest binary, start int, times int")
    twice = found.groupBy("window").agg(F.sum("times").alias("times")).filter("times > 1").select("window")
    starts = found.join(twice, "window").groupBy("digest").agg(F.sort_array(F.collect_set("start")).alias("starts"))

    def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zero = np.zeros(1, np.int64)
        for digests, places in column_lists(batches):
            runs = [runs_by_segment(np.array(p, np.int64), zero, span)[0] for p in places]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(runs, pa.list_(pa.int32()))], ["digest", "runs"])

    return map_batches(starts, union, "digest binary, runs array<int>")


def _stage_small(df: DataFrame, name: str) -> DataFrame:
    """As ``stage``, packed tighter: the bodies of neighbouring segments overlap."""
    spark = df.sparkSession
    codec = spark.conf.get("spark.sql.parquet.compression.codec")
    spark.conf.set("spark.sql.parquet.compression.codec", "zstd")
    try:
        return stage(df, name)
    finally:
        spark.conf.set("spark.sql.parquet.compression.codec", codec)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text with marked runs: bytes and runs removed, and the digest of the rest."""
    for keys, texts, runs in column_lists(batches):
        removed, spans, digests = [], [], []
        for text, marks in zip(texts, runs):
            data, kept, end, count, gone = _bytes(text), sha256(), 0, 0, 0
            for begin, stop in sorted(map(tuple, marks)):
                if begin > end or not count:
                    kept.update(data[end:begin])
                    count += 1
                    gone += stop - begin
                    end = stop
                elif stop > end:
                    gone += stop - end
                    end = stop
            kept.update(data[end:])
            removed.append(gone)
            spans.append(count)
            digests.append(kept.hexdigest())
        kinds = (pa.binary(), pa.int64(), pa.int64(), pa.string())
        columns = (keys, removed, spans, digests)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "gone", "runs", "kept"])


def repeated_spans(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
    shard: int = SHARD,
    group: int = GROUP,
) -> DataFrame:
    """One row per input row: id, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    Matches never cross texts, and are judged on the input. Null texts count as empty: nothing is
    removed, and the digest is that of nothing. Texts shorter than ``span`` keep everything. Rows
    that repeat a text, with the same id or another, lose all of it where it has ``span`` bytes.
    Ids may be null; an empty table gives an empty result; other columns are not read.
    """
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    facts = "id long, key binary, n_bytes long, sha256 string, hashes array<long>"
    rows = stage(map_batches(source, _row_facts(span, gram), facts), "facts")
    # One row stands for each text: that of the least id.
    texts = stage(rows.groupBy("key").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")), "texts")
    standing = texts.select("key", F.col("least").alias("id"))
    same_row = (F.col("l.key") == F.col("r.key")) & F.col("l.id").eqNullSafe(F.col("r.id"))
    long = rows.filter(F.size("hashes") > 0).select("key", "id", "hashes").alias("l")
    stands = long.join(standing.alias("r"), same_row, "left_semi")
    anchors = stands.select("key", "id", F.explode("hashes").alias("hash"))
    frequent = anchors.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("hash")
    wanted = anchors.join(frequent, "hash").groupBy("key", "id").agg(F.collect_set("hash").alias("wanted"))

    own_key = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    named = source.filter(F.octet_length("text") >= span).withColumn("key", own_key).alias("l")
    found = named.join(wanted.alias("r"), same_row)
    held = _stage_small(found.select("l.key", "text", "wanted"), "held")

    parts = "key binary, start int, hash long, digest binary, body binary"
    segments = _stage_small(map_batches(held, _segments(span, gram), parts), "segments")
    distinct = segments.groupBy("hash", "digest").agg(
        F.first("body").alias("body"), (F.count(F.lit(1)) > 1).alias("repeated")
    )
    dealt = distinct.repartition(width(docs.sparkSession), "hash").sortWithinPartitions("hash")
    marks = stage(map_batches(dealt.select("hash", "digest", "body", "repeated"), _marks_of_sorted(span, shard, group), MARKS), "marks")
    runs = marks.filter("not again").select("digest", "runs")
    passed = marks.filter("again")
    if not passed.isEmpty():
        runs = runs.unionByName(_counted_across(passed, span))

    pairs = "transform(sequence(0, size(runs) - 2, 2), i -> array(start + runs[i], start + runs[i + 1]))"
    placed = segments.select("key", "start", "digest").join(runs, "digest").select("key", F.expr(pairs).alias("pairs"))
    marked = placed.groupBy("key").agg(F.flatten(F.collect_list("pairs")).alias("marks"))
    cut = map_batches(
        held.join(marked, "key").select("key", "text", "marks"), _cut, "key binary, gone long, runs long, kept string"
    )
    # Rows that repeat id and text stand for their text together.
    cut = cut.dropDuplicates(["key"])

    facts = texts.select("key", "copies").join(cut, "key", "left")
    whole = (F.col("copies") > 1) & (F.col("n_bytes") >= span)
    return rows.join(facts, "key").select(
        F.col("id").alias(id_column),
        "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("gone", F.lit(0))).cast("long").alias("n_removed"),
        F.when(whole, 1).otherwise(F.coalesce("runs", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "sha256")).alias("kept_sha256"),
    )
