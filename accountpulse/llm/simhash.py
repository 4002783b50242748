"""SimHash near-duplicates by deletion-variant signatures.

A 64-bit fingerprint is cut into ``distance // 2 + 1`` segments. Of two fingerprints that differ in
at most ``distance`` bits, one segment differs in at most one bit. Each segment is indexed once
per position with that position left out (a one-wildcard variant), so the two fingerprints share
a variant of that segment, and an equality shuffle on variants brings them together for the exact
check. With distance 4 that is three segments and 64 rows for each different fingerprint.

Equal fingerprints are one node, so copies cost one row each. A variant that many fingerprints
share is never expanded to pairs: breadth-first search inside it emits one link for each
fingerprint it reaches, which keeps every component. A variant with more than ``GROUP`` fingerprints
is passed on by a stream and dealt out again by variants of the remaining bits; the check itself
stays exact. Components of the links are then found across the cluster.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from .common import column_lists, map_batches, width
from .components import components

BITS = 64
SEED = 42
#: Fingerprints link at this many differing bits or fewer.
DISTANCE = 4
#: Words in a shingle.
SHINGLE = 4
#: A variant with more fingerprints is dealt out again by its remaining bits.
GROUP = 20_000
#: Up to this size all pairs of a variant are compared side by side.
SMALL = 24

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> list[int]:
    """Unsigned XXH64 of the shingles of one text, repeats included."""
    words = WORD.findall(text.encode("utf-8").lower()) if text else []
    if len(words) > shingle:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    else:
        grams = [b" ".join(words)] if words else []
    return list(map(xxhash.xxh64_intdigest, grams, repeat(SEED)))


def majority(hashes: list[list[int]]) -> np.ndarray:
    """Fingerprint of each list of hashes: a bit is set where over half the hashes have it."""
    sizes = np.array([len(h) for h in hashes], np.int64)
    out = np.zeros(len(hashes), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    flat = np.fromiter((x for i in full for x in hashes[i]), np.uint64, sizes.sum())
    bits = np.unpackbits(flat.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    starts = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
    counts = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
    wins = (2 * counts > sizes[full][:, None]).astype(np.uint8)
    out[full] = np.packbits(wins, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def _fingerprint_batches(shingle: int) -> Callable:
    limit = 200_000  # hashes that are unpacked at once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, digests, texts in column_lists(batches):
            prints, waiting, held = [], [], 0
            for text in texts:
                waiting.append(shingle_hashes(text, shingle))
                held += len(waiting[-1])
                if held > limit:
                    prints.append(majority(waiting))
                    waiting, held = [], 0
            prints.append(majority(waiting))
            column = pa.array(np.concatenate(prints).view(np.int64))
            own = [pa.array(ids, pa.int64()), pa.array(digests, pa.int64()), column]
            yield pa.RecordBatch.from_arrays(own, ["id", "digest", "fp"])

    return run


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = SHINGLE
) -> DataFrame:
    """``id``, ``digest`` (a hash of the text), ``fp`` (the 64 bits as a signed long), one row per input row.

    Texts without a word, null and empty ones included, have fingerprint zero. Ids are carried as
    they are, null and repeated ones too.
    """
    source = docs.select(
        F.col(id_column).cast("long").alias("id"), F.xxhash64(text_column).alias("digest"), F.col(text_column).alias("text")
    )
    return map_batches(source, _fingerprint_batches(shingle), "id long, digest long, fp long")


def segments(distance: int, free: list[int]) -> list[list[int]]:
    """The bit positions ``free``, cut into ``distance // 2 + 1`` runs of nearly equal length."""
    return [list(map(int, run)) for run in np.array_split(np.array(free), distance // 2 + 1)]


def variants(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``key``, ``seg``, ``fp``: a fingerprint once per segment and left-out bit of it."""
    cells = []
    for number, run in enumerate(segments(distance, list(range(BITS)))):
        low, mask = run[0], (1 << len(run)) - 1
        for at in range(len(run)):
            # The key holds the segment's other bits and which bit is left out.
            cells.append(f"struct({(low + at) << 48}L | (shiftrightunsigned(fp, {low}) & {mask & ~(1 << at)}L), {number})")
    rows = prints.select("fp", F.explode(F.expr(f"array({', '.join(cells)})")).alias("cell"))
    return rows.select(F.col("cell.col1").alias("key"), F.col("cell.col2").alias("seg"), "fp")


def _star_links(prints: np.ndarray, distance: int) -> tuple[list, list]:
    """Links that join the fingerprints of one group into their components, one per fingerprint reached."""
    left, right = [], []
    unseen = prints
    while len(unseen):
        front, unseen = [unseen[0]], unseen[1:]
        while front and len(unseen):
            here = front.pop()
            near = np.bitwise_count(unseen ^ here) <= distance
            if near.any():
                reached, unseen = unseen[near], unseen[~near]
                left.append(reached)
                right.append(np.full(len(reached), here))
                front.extend(reached)
    return left, right


def _group_links(keys: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside whole groups of equal keys; rows are sorted by key."""
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    sizes = np.diff(np.concatenate((starts, [len(keys)])))
    left, right = [], []
    small = np.repeat(sizes <= SMALL, sizes)
    for gap in range(1, SMALL):
        same = small[gap:] & (keys[gap:] == keys[:-gap])
        if not same.any():
            break
        at = np.flatnonzero(same)
        a, b = prints[at], prints[at + gap]
        near = np.bitwise_count(a ^ b) <= distance
        left.append(a[near])
        right.append(b[near])
    for g in np.flatnonzero(sizes > SMALL):
        more = _star_links(prints[starts[g] : starts[g] + sizes[g]], distance)
        left += more[0]
        right += more[1]
    empty = np.zeros(0, np.uint64)
    return np.concatenate([*left, empty]), np.concatenate([*right, empty])


LINK_ROWS = "again boolean, key long, seg int, u long, v long"


def _links_of_sorted(distance: int, group: int) -> Callable:
    """Rows sorted by key to links; rows of a group beyond ``group`` come back with ``again`` set."""

    def rows(again, key, seg, u, v):
        n = len(u)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, again)),
                pa.array(np.broadcast_to(np.asarray(key, np.int64), n)),
                pa.array(np.broadcast_to(np.asarray(seg, np.int32), n)),
                pa.array(u.view(np.int64)),
                pa.array(v.view(np.int64)),
            ],
            ["again", "key", "seg", "u", "v"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = np.zeros(0, np.int64)
        prints = np.zeros(0, np.uint64)
        segs = np.zeros(0, np.int32)
        passing = None  # key of a group that is being passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(0).to_numpy()
            s = batch.column(1).to_numpy()
            p = batch.column(2).to_numpy().view(np.uint64)
            if passing is not None:
                cut = int(np.searchsorted(k, passing, "right"))
                if cut:
                    yield rows(True, passing, s[:cut], p[:cut], p[:cut])
                k, s, p = k[cut:], s[cut:], p[cut:]
                if not len(k):
                    continue
                passing = None
            keys, segs, prints = np.concatenate((keys, k)), np.concatenate((segs, s)), np.concatenate((prints, p))
            last = int(np.searchsorted(keys, keys[-1], "left"))
            if last:
                u, v = _group_links(keys[:last], prints[:last], distance)
                if len(u):
                    yield rows(False, 0, 0, u, v)
            keys, segs, prints = keys[last:], segs[last:], prints[last:]
            if len(keys) > group:
                passing = keys[0]
                yield rows(True, passing, segs, prints, prints)
                keys, segs, prints = keys[:0], segs[:0], prints[:0]
        if len(keys):
            u, v = _group_links(keys, prints, distance)
            if len(u):
                yield rows(False, 0, 0, u, v)

    return run


def _second_variants(rows: DataFrame, distance: int) -> DataFrame:
    """Rows of large groups, keyed anew by variants of the bits outside their segment."""
    whole = segments(distance, list(range(BITS)))
    cells = []
    for run in whole:
        rest = [b for b in range(BITS) if b not in run]
        masks = []
        for number, part in enumerate(segments(distance, rest)):
            word = sum(1 << b for b in part)
            for bit in part:
                mask = word & ~(1 << bit)
                masks.append(f"xxhash64(key, {number}, {bit}, fp & {mask - (1 << 64) if mask >> 63 else mask}L)")
        cells.append(f"array({', '.join(masks)})")
    choice = " ".join(f"WHEN {n} THEN {c}" for n, c in enumerate(cells))
    return rows.select(F.explode(F.expr(f"CASE seg {choice} END")).alias("key"), "seg", "fp")


def _linked(rows: DataFrame, distance: int, group: int) -> DataFrame:
    dealt = rows.repartition(width(rows.sparkSession), "key").sortWithinPartitions("key")
    return stage(map_batches(dealt, _links_of_sorted(distance, group), LINK_ROWS), "near")


def near_links(prints: DataFrame, distance: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """Links ``(u, v)`` between different fingerprints that keep the components of all of them.

    ``prints`` has different values ``fp``; at least every component's spanning links are returned,
    each checked to differ in at most ``distance`` bits.
    """
    first = _linked(variants(prints, distance), distance, group)
    links = first.filter("not again").select("u", "v")
    large = first.filter("again")
    if not large.isEmpty():
        # Groups of a second variant share at least two segments' worth of bits; they are searched whole.
        again = _second_variants(large.select("key", "seg", F.col("u").alias("fp")), distance)
        links = links.unionByName(_linked(again, distance, 1 << 62).select("u", "v"))
    return links


def labelled(docs: DataFrame, id_column: str, text_column: str, distance: int, shingle: int) -> DataFrame:
    """``id``, ``digest``, ``fp``, ``class_size``, ``root``, ``component_id``, one row per input row."""
    rows = stage(fingerprints(docs, id_column, text_column, shingle), "prints")
    classes = stage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("class_size")), "classes")
    roots = components(near_links(classes.select("fp"), distance))
    named = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", "class_size", F.coalesce("root", "fp").alias("root")
    )
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(best, "root").select("fp", "class_size", "root", "component_id"), "fp")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per input row: id, ``fingerprint`` (16 hex digits), ``component_id``, ``class_size``.

    ``component_id`` is the least id that links reach, the row's own included; null ids count only
    where a component has no other, and it is null then. ``class_size`` counts the rows with the
    same fingerprint. Empty tables give an empty result; other columns are not read.
    """
    return labelled(docs, id_column, text_column, distance, shingle).select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        "class_size",
    )


def drop_near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    distance: int = DISTANCE,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row of each component of ``docs``, with all its columns: the one of the least id.

    Rows are found again by id and a hash of the text; of several texts under one id the one of
    the least hash stays, and of rows that repeat both one stays. Null ids rank last. Texts
    without a word link to each other like any other text.
    """
    return least_rows(docs, stage(labelled(docs, id_column, text_column, distance, shingle), "labelled"), id_column, text_column)


def least_rows(docs: DataFrame, rows: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Of each ``root`` of ``rows`` (``id``, ``digest``, ``root``), the row of ``docs`` that ``drop_near_duplicates`` keeps."""
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "digest")
    kept = rows.groupBy("root").agg(F.min(rank).alias("k")).select("k.id", "k.digest")
    repeated = rows.groupBy("id", "digest").count().filter("count > 1").select("id", "digest")
    own = docs.withColumn("__digest", F.xxhash64(text_column))

    def keyed(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        named = right.toDF("__id", "__of")
        return left.join(named, F.col(id_column).eqNullSafe(F.col("__id")) & (F.col("__digest") == F.col("__of")), how)

    found = keyed(own, kept, "left_semi")
    if not repeated.isEmpty():
        twins = keyed(found, repeated, "left_semi").dropDuplicates([id_column, "__digest"])
        found = keyed(found, repeated, "left_anti").unionByName(twins)
    return found.drop("__digest")
