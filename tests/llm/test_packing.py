import random
import struct
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from accountpulse.llm import packing
from accountpulse.llm.common import table
from accountpulse.llm.queries import BYTES, QUERIES

from . import awkward

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(BYTES)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def coded(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def check(pieces, texts, library, size=2048):
    """Every document's ids lie in its pieces once and in order; sequences are full or powers of two."""
    wanted = sorted((str(k), coded(library.encode(t or "", add_special_tokens=False).ids + [1])) for k, t in texts)
    by, places = {}, {}
    for r in pieces:
        by.setdefault(r["doc_id"], []).append(r)
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        assert len(r["ids"]) == 4 * r["length"] > 0
    found = []
    for key, rows in by.items():
        # Rows of one id may be several documents: each starts at 0, and a sequence goes on where one ended.
        rows.sort(key=lambda r: (r["sequence_id"], r["offset"]))
        ids = b""
        for r in rows:
            assert r["start"] == len(ids) // 4
            ids += bytes(r["ids"])
            if len(ids) == 4 * r["doc_tokens"]:
                found.append((str(key), ids))
                ids = b""
        assert not ids
    assert sorted(found) == wanted
    assert sorted(places) == list(range(len(places)))
    for number, parts in places.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0
        places[number] = at
    assert sum(places.values()) == sum(len(ids) // 4 for _, ids in wanted)
    assert all(a >= b for a, b in zip(list(dict(sorted(places.items())).values()), list(dict(sorted(places.items())).values())[1:]))


def test_query_against_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in table(spark, FOLDER, "documents").collect()}
    rows = QUERIES["op13_packing"](spark, FOLDER).collect()
    whole = {k: library.encode(t or "", add_special_tokens=False).ids + [1] for k, t in docs.items()}
    for r in rows:
        part = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] and r["ids_crc32"] == zlib.crc32(coded(part)) and r["doc_tokens"] == len(whole[r["doc_id"]])
    assert sum(r["length"] for r in rows) == sum(map(len, whole.values()))


@pytest.mark.parametrize("size", [2048, 64, 1])
def test_awkward_rows(spark, library, size):
    rows = awkward.documents(count=20 if size == 1 else 60)
    rows = [r for r in rows if size > 1 or not r[1] or len(r[1]) < 1000]
    docs = awkward.frame(spark, rows, 5)
    check(packing.packed(docs, PATH, size).collect(), [r[:2] for r in rows], library, size)


def test_bundles_of_partitions(spark, library, monkeypatch):
    monkeypatch.setattr(packing, "BUNDLE", 3)
    rows = [(i, f"word {i} " * (i % 9), *[None] * 8) for i in range(200)]
    check(packing.packed(awkward.frame(spark, rows, 17), PATH, 32).collect(), [r[:2] for r in rows], library, 32)


def test_sequences(spark, library):
    rows = awkward.documents()
    pieces = packing.packed(awkward.frame(spark, rows), PATH, 128)
    whole = packing.sequences(pieces).orderBy("sequence_id").collect()
    assert [r["n_tokens"] for r in whole][:-1].count(128) >= len(whole) - 8
    run = b"".join(bytes(r["ids"]) for r in whole)
    ordered = pieces.orderBy("sequence_id", "offset").collect()
    assert run == b"".join(bytes(r["ids"]) for r in ordered)


def test_empty_table(spark):
    assert packing.packed(awkward.empty(spark), PATH).collect() == []


def test_encoder_equals_library(library):
    """Texts of every kind of white space, signs, contractions and special tokens, with and without the faster merge."""
    pick = random.Random(3)
    bits = [" ", "  ", "\n", "\n\n", "\t", " \n", "a", "é", "ab", "'s", "'", "1", "23", ".", ",", "<|endoftext|>", "<|", "ß", "漢", "\u200b"]
    bits += ["\xa0", "\u3000", "İ", "_", "-", "'ll", " 't", "\x1c", "\x85", "😀", "e\u0301", "Straße", "ﬁ", "ñandú", "ẞ", "Ɐ"]
    fast, slow = packing.Encoder(PATH), packing.Encoder(PATH)
    assert fast.merged is not None
    slow.merged = None
    for _ in range(20_000):
        text = "".join(pick.choice(bits) for _ in range(pick.randint(0, 14)))
        ids = coded(library.encode(text, add_special_tokens=False).ids)
        assert fast.ids(text) == ids and slow.ids(text) == ids, repr(text)


def test_every_latin_character_beside_every_other(library):
    """The faster merge and the library split words alike on all of Latin-1."""
    codes = packing.Encoder(PATH)
    for a in range(256):
        text = "".join(f"{chr(a)}{chr(b)}{chr(a)} {chr(b)}x" for b in range(256))
        assert codes.simple(text)
        assert codes.ids(text) == coded(library.encode(text, add_special_tokens=False).ids), a


def test_random_words(library):
    codes, pick = packing.Encoder(PATH), random.Random(5)
    for _ in range(300):
        text = " ".join("".join(pick.choices("abcdeéinotr", k=pick.randint(1, 60))) for _ in range(20))
        assert codes.ids(text) == coded(library.encode(text, add_special_tokens=False).ids)


def test_other_vocabularies_go_to_the_library(library):
    other = public_tokenizers.path("word_bpe_49k.json")
    codes = packing.Encoder(other)
    assert codes.merged is None
    assert codes.ids("Some Words") == coded(Tokenizer.from_file(other).encode("Some Words", add_special_tokens=False).ids)


def test_a_long_text_without_spaces(library):
    text = "ab" * 100_000
    assert packing.Encoder(PATH).ids(text) == coded(library.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("rest", [0, 1, 2, 3, 1023, 2047, 1500])
def test_rest_is_cut_at_powers_of_two(rest):
    edges = packing.rest_edges(rest)
    assert edges[-1] == rest
    lengths = [b - a for a, b in zip(edges, edges[1:])]
    assert all(n & (n - 1) == 0 for n in lengths) and lengths == sorted(set(lengths), reverse=True)
