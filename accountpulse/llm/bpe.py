"""Byte-pair encoding as a streaming transducer with bounded lookahead, and its decoding.

Merging is greedy by rank, yet what follows can change a token only through a chain of merges, each
taking the right end of the one before and each of a lower rank. The longest such chain of a merge
list is its sufficient lookahead (``sufficient_lookahead``). The transducer keeps a window of
symbols that starts at a token boundary; a token that ends at least that far before the window's
end can't change, so it is emitted and forgotten. A word of any length takes constant memory, and
a word shorter than the lookahead is one window.

Decoding runs the tokens' bytes through an incremental UTF-8 state machine, block by block.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import repeat

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from .common import column_lists, map_batches

NONE = 1 << 62
#: Characters of text that are normalised and cut into words at once, up to the next space.
BLOCK = 1 << 16
#: Words whose tokens a worker keeps.
MEMORY = 300_000
#: Token ids that are hashed and decoded at once.
IDS = 1 << 16

# The contractions that the vocabulary's word pattern splits off.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[int, int]], made: list[int], length: dict[int, int]) -> int:
    """Symbols after a token's end that can still change it.

    ``merges`` are pairs in order of rank, ``made`` the token of each, ``length`` the symbols of
    every token. Whether a merge (x, y) happens hangs on merges (s, z) in which s is y, or the right
    part of it at some depth, and which rank below the merge that takes s. So the need of each merge
    follows from those of lower ranks, and the answer is the largest of all.
    """
    born = {token: rank for rank, token in enumerate(made)}
    ranks: dict[int, list[int]] = {}
    reach: dict[int, list[int]] = {}
    most = 0
    for rank, (left, right) in enumerate(merges):
        need, part, taken = 0, right, rank
        while True:
            at = bisect_left(ranks.get(part, ()), taken)
            if at:
                need = max(need, reach[part][at - 1])
            if part not in born:
                break
            taken = born[part]
            if taken >= rank:
                raise ValueError("A merge ranks before one of its parts.")
            part = merges[taken][1]
        total = length[right] + need
        ranks.setdefault(left, []).append(rank)
        known = reach.setdefault(left, [])
        known.append(max(total, known[-1]) if known else total)
        most = max(most, total)
    return most


class Vocabulary:
    """Merges, tokens and special tokens of one tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        ids = model["vocab"]
        end = model["end_of_word_suffix"]
        alphabet = byte_alphabet()
        self.first = [ids[c] for c in alphabet]
        self.last = [ids[c + end] for c in alphabet]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = [(ids[a], ids[b]) for a, b in pairs]
        self.made = [ids[a + b] for a, b in pairs]
        self.ranks = {pair: rank for rank, pair in enumerate(merges)}
        length = dict.fromkeys([*self.first, *self.last], 1)
        for (a, b), token in zip(merges, self.made):
            length[token] = length[a] + length[b]
        self.lookahead = sufficient_lookahead(merges, self.made, length)
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        shown = {i: t for t, i in ids.items()} | {i: t for t, i in self.special.items()}
        self.shown = [shown.get(i, "").encode() for i in range(max(shown) + 1)]
        byte_of = {c: bytes([b]) for b, c in enumerate(alphabet)}
        plain = {}
        for token, i in ids.items():
            body = token[: -len(end)] if token.endswith(end) else token
            plain[i] = b"".join(byte_of[c] for c in body) + b" " * token.endswith(end)
        plain |= {i: t.encode() for t, i in self.special.items()}
        self.plain = [plain.get(i, b"") for i in range(max(plain) + 1)]

    def merge(self, symbols: list[int]) -> list[int]:
        """Greedy merging by rank, leftmost first, of a few symbols."""
        get, made = self.ranks.get, self.made
        ranks = list(map(get, zip(symbols, symbols[1:]), repeat(NONE)))
        while ranks:
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            symbols[at : at + 2] = [made[best]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = get((symbols[at], symbols[at + 1]), NONE)
            if at:
                ranks[at - 1] = get((symbols[at - 1], symbols[at]), NONE)
        return symbols


class Transducer:
    """Tokens of one word, symbol block by symbol block, in constant memory."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.window: list[int] = []
        self.size = 2 * vocabulary.lookahead + 256

    def feed(self, symbols: list[int]) -> Iterator[list[int]]:
        """Tokens that are stable after these symbols."""
        for start in range(0, len(symbols), self.size):
            self.window += symbols[start : start + self.size]
            if len(self.window) >= self.size:
                yield self._stable()

    def _stable(self) -> list[int]:
        limit, out, used = len(self.window) - self.vocabulary.lookahead, [], 0
        for token in self.vocabulary.merge(list(self.window)):
            end = used + self._length(token)
            if end > limit:
                break
            out.append(token)
            used = end
        self.window = self.window[used:]
        return out

    def _length(self, token: int) -> int:
        body = self.vocabulary.plain[token]
        return len(body) - (token in self._ends)

    @property
    def _ends(self) -> frozenset:
        return _ends_of(self.vocabulary)

    def finish(self) -> list[int]:
        """The rest, once the word has ended."""
        out, self.window = self.vocabulary.merge(self.window), []
        return out


@lru_cache(maxsize=4)
def _ends_of(vocabulary: Vocabulary) -> frozenset:
    return frozenset(i for i, t in enumerate(vocabulary.shown) if t.endswith(b"</w>"))


def _word_symbols(vocabulary: Vocabulary, word: str) -> Iterator[list[int]]:
    data = word.encode("utf-8")
    for start in range(0, len(data) - 1, BLOCK):
        yield [vocabulary.first[b] for b in data[start : min(start + BLOCK, len(data) - 1)]]
    yield [vocabulary.last[data[-1]]]


def _packed(tokens: list[int]) -> bytes:
    packed = array("I", tokens)
    if sys.byteorder == "big":
        packed.byteswap()
    return packed.tobytes()


class Kept(dict):
    """Packed token ids by key; what is new is made, and short keys are kept."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        packed = self.make(key)
        if len(key) < 64:
            if len(self) >= MEMORY:
                self.clear()
            self[key] = packed
        return packed


#: Contractions, runs of letters, single digits, runs of other characters but spaces.
WORD = regex.compile(CONTRACTIONS + r"|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")
#: Characters that ``str.split`` takes for spaces and the word pattern doesn't.
SEPARATORS = re.compile("[\x1c-\x1f]")
SPACE = re.compile(r"[ \n]")


class Encoder:
    """Token ids of a text, as packed blocks of little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        self.vocabulary = _vocabulary(path)
        self.words = Kept(self._word)
        self.runs = Kept(self._run)
        self.special = re.compile("|".join(map(re.escape, sorted(self.vocabulary.special, key=len, reverse=True))))

    def _word(self, word: str) -> bytes:
        machine = Transducer(self.vocabulary)
        if len(word) * 4 <= self.vocabulary.lookahead:  # one window
            data, first = word.encode("utf-8"), self.vocabulary.first
            machine.window = [*map(first.__getitem__, data[:-1]), self.vocabulary.last[data[-1]]]
            return _packed(machine.finish())
        packed = []
        for symbols in _word_symbols(self.vocabulary, word):
            packed += map(_packed, machine.feed(symbols))
        return b"".join([*packed, _packed(machine.finish())])

    def _run(self, run: str) -> bytes:
        """Token ids of a run of characters between spaces."""
        words = WORD.findall(run)
        return self._word(run) if words == [run] else b"".join(map(self.words.__getitem__, words))

    def blocks(self, text: str) -> Iterator[bytes]:
        at = 0
        for found in self.special.finditer(text):
            yield from self._plain(text, at, found.start())
            yield self.vocabulary.special[found[0]].to_bytes(4, "little")
            at = found.end()
        yield from self._plain(text, at, len(text))

    def _plain(self, text: str, start: int, end: int) -> Iterator[bytes]:
        while start < end:
            cut = SPACE.search(text, min(start + BLOCK, end), end)
            stop = cut.start() if cut else end
            piece = unicodedata.normalize("NFC", text[start:stop])
            # Character by character: no special form of a sigma at the end of a word.
            piece = piece.replace("Σ", "σ").lower()
            runs = piece.split(" ") if SEPARATORS.search(piece) else piece.split()
            yield b"".join(map(self.runs.__getitem__, runs))
            start = stop if stop > start else end


class Decoder:
    """Text of token ids, block by block.

    ``shown`` joins the tokens' written forms by spaces, as a tokenizer without a decoder does;
    otherwise bytes are restored and word ends become spaces.
    """

    def __init__(self, path: str, shown: bool = True):
        vocabulary = _vocabulary(path)
        self.table = vocabulary.shown if shown else vocabulary.plain
        self.joint = b" " if shown else b""
        self.started = False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        data = self.joint.join(map(self.table.__getitem__, ids))
        if self.started and data:
            data = self.joint + data
        self.started = self.started or bool(data)
        return self.machine.decode(data)

    def finish(self) -> str:
        return self.machine.decode(b"", True)


@lru_cache(maxsize=2)
def _vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(text: str | None, path: str) -> list[int]:
    """Token ids of one text; null and empty texts have none."""
    out = array("I", b"".join(encoder(path).blocks(text or "")))
    if sys.byteorder == "big":
        out.byteswap()
    return out.tolist()


def decode(ids: Iterable[int], path: str, shown: bool = True) -> str:
    """Text of token ids."""
    machine = Decoder(path, shown)
    return machine.feed(ids) + machine.finish()


def _digest_batches(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for keys, texts in column_lists(batches):
            counts, own, back = [], [], []
            for text in texts:
                count, ids, decoded = 0, sha256(), sha256()
                machine = Decoder(path)
                for block in coder.blocks(text or ""):
                    ids.update(block)
                    count += len(block) // 4
                    view = memoryview(block)
                    for start in range(0, len(block), 4 * IDS):
                        part = array("I", view[start : start + 4 * IDS].tobytes())
                        if sys.byteorder == "big":
                            part.byteswap()
                        decoded.update(machine.feed(part).encode())
                decoded.update(machine.finish().encode())
                counts.append(count)
                own.append(ids.hexdigest())
                back.append(decoded.hexdigest())
            columns = [pa.array(keys, pa.int64()), pa.array(counts, pa.int64()), pa.array(own), pa.array(back)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def token_digests(docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per input row: id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    Null texts count as empty: no tokens, and the digests of nothing. Ids may be null or repeat; an
    empty table gives an empty result; other columns are not read. The vocabulary's file must be at
    ``path`` on every executor. No shuffle.
    """
    source = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    out = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_batches(source, _digest_batches(path), out).withColumnRenamed("id", id_column)


def _token_batches(path: str, decoded: bool) -> Callable:
    def digest(ids: array) -> str:
        machine, text = Decoder(path), sha256()
        for start in range(0, len(ids), IDS):
            text.update(machine.feed(ids[start : start + IDS]).encode())
        text.update(machine.finish().encode())
        return text.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path)
        for batch in batches:
            ids = [array("I", b"".join(coder.blocks(t or ""))) for t in batch.column(0).to_pylist()]
            columns = [*batch.columns[1:], pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))]
            names = [*batch.schema.names[1:], "tokens"]
            if decoded:
                columns.append(pa.array(list(map(digest, ids)), pa.string()))
                names.append("decoded_sha256")
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def tokenized(docs: DataFrame, path: str, text_column: str = "text", decoded: bool = False) -> DataFrame:
    """``docs`` with a last column ``tokens`` (replacing one of that name), one row per input row.

    With ``decoded``, ``decoded_sha256`` follows: the digest of the text that the tokens decode to. Null
    and empty texts have no tokens and decode to an empty text. Repeated rows give repeated results, an
    empty table an empty one. Other columns stay; a column may have any name but ``__text``.
    """
    more = [StructField("tokens", ArrayType(IntegerType()))]
    if decoded:
        more.append(StructField("decoded_sha256", StringType()))
    rest = docs.drop(*(f.name for f in more))
    source = rest.select(F.col(text_column).alias("__text"), *rest.columns)
    return map_batches(source, _token_batches(path, decoded), StructType([*rest.schema.fields, *more]))
