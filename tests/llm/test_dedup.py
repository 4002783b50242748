import random
import re
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from accountpulse.llm import exact_dedup, repeats, simhash, suffixes
from accountpulse.llm.components import components

from . import awkward


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("support", [0.001, 0.3])
def test_exact_groups(spark, support):
    rows = awkward.documents()
    found = exact_dedup.duplicate_groups(awkward.frame(spark, rows), support=support).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[sha256(lowered(r[1]).encode()).hexdigest()].append(r[0])
    assert len(found) == len(rows)
    kept = Counter(r["text_sha256"] for r in found if r["kept"])
    assert kept == dict.fromkeys(groups, 1)
    for r in found:
        ids = groups[r["text_sha256"]]
        known = [i for i in ids if i is not None]
        assert r["keep_id"] == max(known, default=None) and r["group_size"] == len(ids)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]


def test_exact_rows_stay_whole(spark):
    rows = awkward.documents()
    stays = exact_dedup.drop_duplicates(awkward.frame(spark, rows))
    assert stays.columns == awkward.frame(spark, rows).columns
    texts = [lowered(r["text"]) for r in stays.collect()]
    assert sorted(texts) == sorted({lowered(r[1]) for r in rows})


def fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered(text).encode())
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints):
    """Root of each different fingerprint, by comparing all."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for p in root:
        for q in root:
            if p < q and (p ^ q).bit_count() <= 4:
                root[find(q)] = find(p)
    return {p: find(p) for p in root}


def test_simhash_against_all_pairs(spark):
    rows = awkward.documents()
    found = simhash.near_duplicates(awkward.frame(spark, rows)).collect()
    prints = [fingerprint(r[1]) for r in rows]
    roots = grouped(set(prints))
    members = defaultdict(list)
    for r, p in zip(rows, prints):
        members[roots[p]].append(r[0])
    least = {k: min((i for i in v if i is not None), default=None) for k, v in members.items()}
    expected = Counter((r[0], f"{p:016x}", least[roots[p]]) for r, p in zip(rows, prints))
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found) == expected


@pytest.mark.parametrize("group", [20_000, 30, 2])
def test_links_keep_components(spark, group):
    """Clusters larger than a group, and chains, against all pairs."""
    pick = np.random.default_rng(1)
    prints = set()
    for centre in pick.integers(0, 1 << 63, 4):
        for _ in range(60):
            print_ = int(centre)
            for bit in pick.integers(0, 64, int(pick.integers(0, 6))):
                print_ ^= 1 << int(bit)
            prints.add(print_)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp long"), group=group)
    for u, v in links.collect():
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= 4
    roots = components(links).collect()
    found = defaultdict(set)
    for node, root in roots:
        found[root].add(node % (1 << 64))
    expected = defaultdict(set)
    for p, root in grouped(prints).items():
        expected[root].add(p)
    assert {frozenset(v) for v in found.values()} == {frozenset(v) for v in expected.values() if len(v) > 1}


def test_near_rows_stay_whole(spark):
    rows = awkward.documents()
    stays = simhash.drop_near_duplicates(awkward.frame(spark, rows)).collect()
    roots = grouped({fingerprint(r[1]) for r in rows})
    assert sorted(roots[fingerprint(r["text"])] for r in stays) == sorted(set(roots.values()))


def test_components_of_a_chain(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (None, 1)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert found == dict.fromkeys(range(41), 0)


def removed(texts, span):
    """Bytes, removed bytes, runs and digest of the rest, window by window."""
    data = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + span] for b in data for i in range(len(b) - span + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - span + 1):
            if count[b[i : i + span]] > 1:
                gone[i + 1 : i + 1 + span] = True
        runs = int(np.count_nonzero(gone[1:] & ~gone[:-1]))
        rest = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out.append((len(b), int(gone.sum()), runs, sha256(rest).hexdigest()))
    return out


@pytest.mark.parametrize("limits", [{}, {"shard": 300, "group": 1 << 20}, {"shard": 200, "group": 1500}, {"shard": 200, "group": 1}])
def test_repeats_against_windows(spark, limits):
    """One shard, shards merged by search, and anchors that are counted across the cluster."""
    rows = awkward.documents(count=40)
    found = repeats.repeated_spans(awkward.frame(spark, rows), span=40, gram=8, **limits).collect()
    expected = Counter(zip([r[0] for r in rows], removed([r[1] for r in rows], 40)))
    assert Counter((r[0], tuple(r[1:])) for r in found) == expected


def test_periodic_text(spark):
    rows = [(1, "xyz" * 20 + "q" * 90), (2, "abcdefgh" * 9), (3, "0123456789" * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r[0]: tuple(r[1:]) for r in repeats.repeated_spans(docs, span=40, gram=8).collect()}
    assert found == dict(zip((1, 2, 3), removed([r[1] for r in rows], 40)))


def test_suffix_array_and_prefixes():
    pick = np.random.default_rng(2)
    for data in (pick.integers(97, 99, 400), np.full(100, 97), pick.integers(1, 255, 300)):
        data = data.astype(np.uint8)
        whole = data.tobytes()
        order = suffixes.suffix_array(data)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: whole[i:])
        common = suffixes.kasai(suffixes.packed(data), order, np.array([0]), np.array([len(data)]), 1 << 20)
        for at in range(1, len(order)):
            a, b = whole[order[at - 1] :], whole[order[at] :]
            n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[at] >= n and min(common[at], min(len(a), len(b))) == n


def test_empty_tables(spark):
    none = awkward.empty(spark)
    assert exact_dedup.duplicate_groups(none).count() == 0
    assert exact_dedup.drop_duplicates(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    assert repeats.repeated_spans(none).count() == 0
