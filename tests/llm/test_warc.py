import gzip
import io
from hashlib import sha256

import pytest

from accountpulse.llm import warc


def pages():
    big = "é" * 400_000
    rows = [(1, "u", "x" * 300), (2, "u\n2", "x" * 300), (3, None, None), (4, "a b", ""), (None, "n", "x" * 300), (5, "q", "y" * 99)]
    rows += [(6, "q", "y" * 99), (7, "big", big), (7, "big", big), (8, "big", big), (None, "z", "w" * 200), (None, "z", "w" * 200)]
    return [(*r, r[0], "d", "k") for r in rows]


SCHEMA = "page_id long, url string, html string, record long, digest string, kind string"


def expected(rows):
    least = {}
    for r in rows:
        body = (r[2] or "").encode()
        if r[0] is not None and len(body) >= 100:
            least[body] = min(r[0], least.get(body, r[0]))
    for r in rows:
        body = (r[2] or "").encode()
        first = least.get(body)
        again = first is not None and r[0] != first
        yield r[0], len(body), sha256(body).hexdigest(), "revisit" if again else "response", first if again else None


def key(row):
    return tuple(map(str, row))


def test_round_trip(spark):
    rows = pages()
    found = warc.archived(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert sorted((tuple(r)[:5] for r in found.collect()), key=key) == sorted(expected(rows), key=key)
    assert warc.archived(spark.createDataFrame([], SCHEMA)).count() == 0


def test_payloads_in_chunks(spark, tmp_path):
    folder = f"file://{tmp_path}"
    names = warc.write_archives(spark.createDataFrame(pages(), SCHEMA).repartition(2), folder, chunk=1000, archive=250)
    assert names.count() > 2
    parts = warc.read_chunks(names, folder, chunk=777).collect()
    assert max(len(p["data"]) for p in parts) <= 777
    bodies = {}
    for p in sorted(parts, key=lambda p: (p["archive"], p["at"], p["chunk"])):
        bodies[p["archive"], p["at"]] = bodies.get((p["archive"], p["at"]), b"") + p["data"]
    whole = [(r[2] or "").encode() for r, e in zip(pages(), expected(pages())) if e[3] == "response"]
    assert sorted(bodies.values()) == sorted(b for b in whole if b)
    for file in tmp_path.glob("*.warc.gz"):
        assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\nWARC-Type: re")
    assert not list(tmp_path.glob("*.part"))


def test_broken_archive(spark, tmp_path):
    folder = f"file://{tmp_path}"
    names = warc.write_archives(spark.createDataFrame([(1, "u", "x" * 5000, 1, "d", "k")], SCHEMA), folder)
    (file,) = tmp_path.glob("*.warc.gz")
    plain = gzip.decompress(file.read_bytes())
    file.write_bytes(gzip.compress(plain.replace(b"xx\r\n\r\n", b"xy\r\n\r\n")))
    with pytest.raises(Exception, match="digest"):
        warc.read_records(names, folder).collect()
    file.write_bytes(gzip.compress(plain[:-900]))
    with pytest.raises(Exception, match="ends inside"):
        warc.read_records(names, folder).collect()


def test_pieces_of_zipped_members():
    body = b"".join(gzip.compress(bytes([65 + i]) * n) for i, n in enumerate((0, 5, 100_000, 64, 1000)))
    for size in (1, 7, 64, 1000):
        pieces = list(warc.unzipped(io.BytesIO(body), size))
        assert b"".join(pieces) == b"B" * 5 + b"C" * 100_000 + b"D" * 64 + b"E" * 1000
        assert max(map(len, pieces)) <= size


