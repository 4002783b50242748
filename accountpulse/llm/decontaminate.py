"""Benchmark passages in documents, by pigeonhole pieces and bit-parallel edit distance.

A passage with at most k edits against a test item holds one of the item's k + 1 pieces unchanged.
All pieces are searched for in one pass over each text; where one is hit, Myers' bit-parallel
search over the window that the piece's place implies gives the least edit distance of the item
to any passage there. So no match within the budget is missed and none beyond it is reported.

Items are taken in blocks of bounded size. A block goes to the tasks with the code and the
documents are read once per block; usually there is one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

#: Edits allowed per character of an item.
RATE = 0.05
#: Characters of item text in a block, on average.
BLOCK_CHARS = 1_000_000


def normalised(text: str | None) -> str:
    """Lower case, one space between words."""
    return " ".join((text or "").lower().split())


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """``budget + 1`` pieces of nearly equal length, with their places."""
    cuts = [len(item) * i // (budget + 1) for i in range(budget + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def least_edits(masks: dict[str, int], size: int, text: str, limit: int) -> int:
    """Least edit distance of the item to any part of ``text``; above ``limit``, some larger number.

    ``masks`` has the bits of the item's places by character, ``size`` the item's length.
    """
    full, high = (1 << size) - 1, 1 << (size - 1)
    up, down, score, best = full, 0, size, size
    for char in text:
        same = masks.get(char, 0)
        vertical = same | down
        across = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(across | up))
        fall = up & across
        if rise & high:
            score += 1
        elif fall & high:
            score -= 1
            if score < best:
                best = score
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = fall | (full & ~(vertical | rise))
        down = rise & vertical
    return best if best <= limit else limit + 1


class Items:
    """Search of one block of items."""

    def __init__(self, items: tuple[tuple[int, str], ...], rate: float):
        self.items = []
        places: dict[str, list[tuple[int, int]]] = {}
        for item, text in items:
            if not text:
                continue
            masks: dict[str, int] = {}
            for i, char in enumerate(text):
                masks[char] = masks.get(char, 0) | 1 << i
            budget = int(rate * len(text))
            for at, piece in pieces(text, budget):
                places.setdefault(piece, []).append((len(self.items), at))
            self.items.append((item, masks, len(text), budget))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places

    def matches(self, text: str | None) -> dict:
        """Item id to least edits, for the items found in the text."""
        found: dict = {}
        if self.empty:
            return found
        body = normalised(text)
        searched, done = set(), set()
        for end, (length, where) in self.automaton.iter(body):
            for number, at in where:
                if number in done:
                    continue
                item, masks, size, budget = self.items[number]
                start = end + 1 - length - at - budget
                stop = start + size + 2 * budget
                if (number, start) in searched:
                    continue
                searched.add((number, start))
                edits = least_edits(masks, size, body[max(0, start) : max(0, stop)], budget)
                if edits <= budget:
                    found[item] = min(edits, found.get(item, edits))
                    if edits == 0:
                        done.add(number)
        return found


@lru_cache(maxsize=2)
def _items(items: tuple, rate: float) -> Items:
    return Items(items, rate)


def item_blocks(
    benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text", block_chars: int = BLOCK_CHARS
) -> Iterator[tuple[tuple[int, str], ...]]:
    """Different items in blocks, one at a time; null and blank items match nothing and are left out."""
    named = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).alias("text"))
    items = named.filter(F.length(F.trim("text")) > 0).distinct()
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    count = int(total // block_chars) + 1
    for block in range(count):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block).collect()
        if rows:
            yield tuple(sorted(((r["item"], normalised(r["text"])) for r in rows), key=repr))


FOUND = "id long, text string, items array<long>, edits array<int>"


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """Pairs of document id, item id and ``n_edits`` where a text holds a passage within the item's budget.

    Case and spacing don't count. Null and empty texts match nothing; rows that repeat give their
    pairs again; items that repeat under one id give one pair with the fewest edits. Ids may be
    null. Without documents or items the result is empty. Documents aren't shuffled.
    """

    def search(items: tuple, first: bool, last: bool) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _items(items, rate)
            for batch in batches:
                texts = batch.column(1)
                found = [finder.matches(t) for t in texts.to_pylist()]
                if not first:
                    # An item's texts may lie in several blocks: the fewest edits count.
                    for own, names, edits in zip(found, batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                        for item, n in zip(names, edits):
                            own[item] = min(n, own.get(item, n))
                columns = [
                    batch.column(0),
                    pa.nulls(len(texts), texts.type) if last else texts,
                    pa.array([list(f) for f in found], pa.list_(pa.int64())),
                    pa.array([list(f.values()) for f in found], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text", "items", "edits"])

        return run

    rows = source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    before, number = None, 0
    for block in item_blocks(benchmark, item_column, item_text_column, block_chars):
        if before:
            rows = map_batches(rows, search(before, number == 1, False), FOUND)
        before, number = block, number + 1
    if not before:
        return source.sparkSession.createDataFrame([], "id long, item long, edits int").toDF(id_column, item_column, "n_edits")
    rows = map_batches(rows, search(before, number == 1, True), FOUND)
    pairs = rows.select("id", F.explode(F.arrays_zip("items", "edits")).alias("pair"))
    return pairs.select("id", "pair.items", "pair.edits").toDF(id_column, item_column, "n_edits")


def drop_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    rate: float = RATE,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """The rows of ``docs`` in whose text no item is found, with all their columns.

    Null and empty texts hold no item and stay, null and empty items are in no text. Repeated rows stay or
    go together. An empty table gives an empty result, an empty benchmark the whole table. A column
    may have any name but ``__text``.
    """

    def clean(items: tuple) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _items(items, rate)
            for batch in batches:
                stays = [not finder.matches(t) for t in batch.column(0).to_pylist()]
                rest = pa.RecordBatch.from_arrays(batch.columns[1:], batch.schema.names[1:])
                yield rest.filter(pa.array(stays, pa.bool_()))

        return run

    for block in item_blocks(benchmark, item_column, item_text_column, block_chars):
        docs = map_batches(docs.select(F.col(text_column).alias("__text"), *docs.columns), clean(block), docs.schema)
    return docs
