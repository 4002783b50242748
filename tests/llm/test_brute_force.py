"""Queries that SQL can't express against plain Python on a whole test folder."""

import math
from collections import Counter
from datetime import date, timedelta
from hashlib import sha256

import numpy as np
import pytest
import regex

from accountpulse.llm import language, pii, quality, toxicity
from accountpulse.llm.common import fold, table
from accountpulse.llm.queries import KEY, QUERIES

from .test_dedup import fingerprint, grouped

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents").collect()


# --- Quality ----------------------------------------------------------------


def strength(groups):
    """Variance inside groups over variance between them, from the values themselves."""
    values = [p for g in groups.values() for p in g]
    n, mean = len(values), sum(values) / len(values)
    means = {k: sum(g) / len(g) for k, g in groups.items()}
    inside = max(sum((p - means[k]) ** 2 for k, g in groups.items() for p in g) / (n - len(groups)), 1e-12)
    apart = sum(len(g) * (means[k] - mean) ** 2 for k, g in groups.items())
    between = (apart - (len(groups) - 1) * inside) / (n - sum(len(g) ** 2 for g in groups.values()) / n)
    return inside / max(between, quality.LEAST_BETWEEN * inside)


def test_quality(spark, docs):
    model = quality.train(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    p = {r["doc_id"]: float(model.probabilities([r["text"]])[0]) for r in docs}
    hosts, paths = {}, {}
    for r in docs:
        hosts.setdefault(r["source"], []).append(p[r["doc_id"]])
        paths.setdefault((r["source"], r["lang"]), []).append(p[r["doc_id"]])
    rate = sum(p.values()) / len(p)
    by_host, by_path = strength(hosts), strength(paths)

    def odds(x):
        x = min(max(x, quality.EDGE), 1 - quality.EDGE)
        return math.log(x / (1 - x))

    found = {r["doc_id"]: r for r in QUERIES["op2_quality"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for r in docs:
        own, host, path = p[r["doc_id"]], hosts[r["source"]], paths[r["source"], r["lang"]]
        host_rate = (sum(host) - own + by_host * rate) / (len(host) - 1 + by_host)
        path_rate = (sum(path) - own + by_path * host_rate) / (len(path) - 1 + by_path)
        score = 1 / (1 + math.exp(-(odds(own) + odds(path_rate) - odds(rate)))) if own else 0.0
        got = found[r["doc_id"]]
        wanted = (own, host_rate, path_rate, score)
        assert (got["evidence"], got["host_rate"], got["path_rate"], got["score"]) == pytest.approx(wanted, rel=1e-9)
        assert got["kept"] == (score >= quality.THRESHOLD)


# --- Personal data ----------------------------------------------------------


def permuted(left, right, a, b, key, tweak):
    for i in range(10):
        drawn = int(sha256(f"{key}:{tweak}:{i}:{right}".encode()).hexdigest()[:15], 16)
        left, right = right, (left + drawn) % (b if i % 2 else a)
    return left, right


def digits_permuted(digits, key, tweak):
    half = len(digits) // 2
    rest = len(digits) - half
    left, right = permuted(int(digits[:half] or 0), int(digits[half:]), 10**half, 10**rest, key, f"{tweak}:{len(digits)}")
    return (str(left).zfill(half) if half else "") + str(right).zfill(rest)


def refilled(shape, digits):
    digits = iter(digits)
    return "".join(next(digits) if c in "0123456789" else c for c in shape)


def luhn(digits):
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(x - 9 * (x > 9) for x in twice)


def pseudonym(value, key):
    kinds = {k: regex.compile(f"(?:{p})") for k, p in pii.PATTERNS.items()}
    digits = regex.sub("[^0-9]", "", value)

    def drawn(kind):
        return sha256(f"{key}:{kind}:{value.lower() if kind == 'email' else value}".encode()).hexdigest()

    if "@" in value:
        return f"p{drawn('email')[:15]}@{value.rsplit('@', 1)[1]}"
    if kinds["ip"].fullmatch(value):
        parts = value.split(".")
        if any(int(x) > 255 or str(int(x)) != x for x in parts):
            return value
        a, b, c, d = map(int, parts)
        left, right = permuted(a * 256 + b, c * 256 + d, 1 << 16, 1 << 16, key, "ip")
        return f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}"
    if kinds["date"].fullmatch(value):
        order = {"-": (0, 1, 2), "/": (2, 0, 1), ".": (2, 1, 0)}
        sign = next(s for s in order if s in value)
        parts = value.split(sign)
        try:
            day = date(*(int(parts[i]) for i in order[sign]))
        except ValueError:
            return value
        number = (day - date(1800, 1, 1)).days
        if not 0 <= number < 189 * 773:
            return value
        left, right = permuted(number // 773, number % 773, 189, 773, key, "date")
        new = date(1800, 1, 1) + timedelta(days=left * 773 + right)
        return new.strftime({"-": "%Y-%m-%d", "/": "%m/%d/%Y", ".": "%d.%m.%Y"}[sign])
    if kinds["ssn"].fullmatch(value):
        area, group, serial = map(int, value.split("-"))
        if not 1 <= area <= 899 or area == 666 or not group or not serial:
            return value
        left, right = permuted(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999, key, "ssn")
        area = left + 1 + (left + 1 >= 666)
        return f"{area:03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"
    if kinds["phone"].fullmatch(value):
        if not 8 <= len(digits) <= 15:
            return value
        country = regex.match(r"\+[0-9]{1,3}(?=[^0-9])", value)
        country = country[0] if country else value[:2]
        rest = value[len(country) :]
        return country + refilled(rest, digits_permuted(regex.sub("[^0-9]", "", rest), key, "phone"))
    if kinds["card"].fullmatch(value):
        if luhn(digits) % 10 or not 13 <= len(digits) <= 19:
            return value
        body = digits_permuted(digits[:-1], key, "card")
        return refilled(value, body + str(-luhn(body + "0") % 10))
    first = drawn("secret")
    return (first + sha256(f"{key}:secret:{value}:2".encode()).hexdigest())[: len(value)]


def hidden(text, key):
    if text is None:
        return None, 0
    changed = 0

    def put(found):
        nonlocal changed
        new = pseudonym(found[0], key)
        changed += new != found[0]
        return new

    out = regex.sub("|".join(f"(?:{p})" for p in pii.PATTERNS.values()), put, text)
    return out, changed


CRAFTED = [
    "4111 1111 1111 1111, 4111-1111-1111-1111, 4111111111111111 and 4111 1111 1111 1112",
    "192.168.0.1 999.1.1.1 01.2.3.4 255.255.255.255",
    "2024-02-29 2023-02-29 02/28/2001 31.12.1999 1799-12-31 2199-12-31 1800-01-01",
    "123-45-6789 666-12-3456 000-12-3456 899-99-9999 665-01-0001 667-01-0001",
    "+1 415 555 2671, +49 (30) 901820, +14155552671, +1 2",
    "Mail A.b+c@Example.co.uk or x@y",
    "d41d8cd98f00b204e9800998ecf8427e " + "0a" * 64 + " " + "a" * 40,
    "",
]


def test_personal_data(spark, docs):
    found = {r["doc_id"]: (r["text"], r["n_private"]) for r in QUERIES["op8_pii"](spark, FOLDER).collect()}
    assert found == {r["doc_id"]: hidden(r["text"], KEY) for r in docs}
    assert sum(n for _, n in found.values()) > 0
    crafted = spark.createDataFrame(list(enumerate(CRAFTED)), "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_private"]) for r in pii.pseudonymised(crafted, "k").collect()}
    assert got == {i: hidden(t, "k") for i, t in enumerate(CRAFTED)}


def test_long_hosts_and_texts(spark):
    """One such text must not end a worker."""
    rows = [(1, "x@" + "a." * 100_000 + "com"), (2, "lorem ipsum " * 900_000), (3, "7" * 1_000_000), (4, "a@" * 100_000)]
    got = {r["doc_id"]: r for r in pii.pseudonymised(spark.createDataFrame(rows, "doc_id long, text string"), "k").collect()}
    assert got[1]["text"].endswith("@" + rows[0][1][2:]) and got[1]["n_private"] == 1
    assert all(got[i]["text"] == rows[i - 1][1] and not got[i]["n_private"] for i in (2, 3, 4))


# --- Language ---------------------------------------------------------------


def trigrams(text, places):
    """Hashed trigrams around every letter, letter by letter."""
    codes = [32, *(ord(c) if c.isalpha() else 32 for c in (text or "").lower()), 32]
    counts = Counter()
    for a, b, c in zip(codes, codes[1:], codes[2:]):
        if b != 32:
            h = ((a * 2654435761 + b) * 2246822519 + c) & 0xFFFFFFFF
            h = ((h ^ h >> 15) * 3266489917) & 0xFFFFFFFF
            counts[(h >> 16) % places] += 1
    return counts


def test_language(spark, docs):
    known = table(spark, FOLDER, "documents").filter(fold("doc_id", 4) != 2)
    model = language.train(known)
    held = {r["doc_id"]: r["held_out"] for r in QUERIES["op9_language"](spark, FOLDER).collect()}
    bags = {r["doc_id"]: trigrams(r["text"], language.PLACES) for r in docs}
    learned = [bags[r["doc_id"]] for r in docs if not held[r["doc_id"]] and r["lang"] is not None and bags[r["doc_id"]]]
    seen = Counter(place for bag in learned for place in bag)
    idf = [math.log((1 + len(learned)) / (1 + seen[i])) + 1 for i in range(language.PLACES)]
    assert model.idf == pytest.approx(idf)
    for r in QUERIES["op9_language"](spark, FOLDER).collect():
        bag = bags[r["doc_id"]]
        if not bag:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        weights = {i: math.sqrt(n) * idf[i] for i, n in bag.items()}
        length = math.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * v[i] for i, w in weights.items()) / length for v in model.vectors]
        best = max(cosines)
        assert r["score"] == pytest.approx(min(max(best, 0.0), 1.0), abs=1e-9)
        assert r["lang_pred"] in {lang for lang, c in zip(model.langs, cosines) if c > best - 1e-9}


def test_copies_count_as_often_as_they_occur(spark):
    """A text that most rows of a language hold is clustered once, with its weight."""
    rows = [(i, "the same words again and again", "en") for i in range(300)]
    rows += [(300 + i, f"other words {'abcdefghij'[i % 10] * 4} here", "en") for i in range(20)]
    rows += [(400 + i, f"autres mots {'klmnopqrst'[i % 10] * 4} ici", "fr") for i in range(20)] + [(500, None, "fr"), (501, "7", "fr")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.train(frame)
    assert set(model.langs) == {"en", "fr"}
    assert [lang for lang, _, _ in model.predict(["the same words again and again", "autres mots ici"])] == ["en", "fr"]
    many = spark.createDataFrame([(i, f"text of kind {i}", f"l{i}") for i in range(1100)], "doc_id long, text string, lang string")
    assert len(set(language.train(many, places=64, clusters=1).langs)) == 1100


# --- Toxicity ---------------------------------------------------------------


def sentences(text):
    """Runs between ends of sentences that hold anything but white space."""
    part = ""
    for c in text or "":
        if c in ".!?\n":
            yield part
            part = ""
        else:
            part += c
    yield part


def test_toxicity(spark, docs):
    labels = table(spark, FOLDER, "labels").filter(fold("doc_id", 5) != 0)
    model = toxicity.train(table(spark, FOLDER, "documents"), labels)
    found = {r["doc_id"]: r for r in QUERIES["op10_toxicity"](spark, FOLDER).collect()}
    assert len(found) == len(docs)
    for r in docs:
        left = 1.0
        for s in sentences(r["text"]):
            if not s.strip():
                continue
            words = {w for w in regex.findall(r"\w+", s.lower())}
            terms = {t for w in words for t in toxicity.terms(w)}
            odds = model.bias + sum(model.weights[t] for t in terms if t in model.weights)
            left *= 1 / (1 + math.exp(min(odds, 700)))
        got = found[r["doc_id"]]
        assert got["score"] == pytest.approx(1 - left, abs=1e-9) and got["predicted"] == int(got["score"] >= 0.5)


def test_one_id_with_most_rows_gives_one_sample_row(spark):
    rows = [(1, f"bad words number {i}") for i in range(400)] + [(2, "fine words"), (3, None), (None, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (9, 1), (None, 1)], "doc_id long, toxic int")
    from accountpulse.llm.common import labelled_sample

    got = labelled_sample(frame, labels, "doc_id", "text", "toxic", 100).collect()
    assert sorted(r["label"] for r in got) == [0, 0, 1]
    assert labelled_sample(frame, labels, "doc_id", "text", "toxic", 2).count() <= 2
    assert toxicity.train(frame, labels).constant is None


# --- Queries on the given tables --------------------------------------------


def test_fingerprints_of_the_given_table(spark, docs):
    roots = grouped({fingerprint(r["text"]) for r in docs})
    least = {}
    for r in docs:
        root = roots[fingerprint(r["text"])]
        least[root] = min(r["doc_id"], least.get(root, r["doc_id"]))
    for r in QUERIES["op4_simhash"](spark, FOLDER).collect():
        assert int(r["fingerprint"], 16) in roots
        assert r["component_id"] == least[roots[int(r["fingerprint"], 16)]]


def test_tokens_of_the_given_table(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found = {r["doc_id"]: r for r in QUERIES["op5_bpe"](spark, FOLDER).collect()}
    for r in docs:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        got = found[r["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got["decoded_sha256"] == sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_repeats_of_the_given_table(spark, docs):
    """Every 200-byte window of the table counted in one dictionary."""
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs}
    seen = Counter(hash(t[i : i + 200]) for t in texts.values() for i in range(len(t) - 199))
    for r in QUERIES["op1_suffix_arrays"](spark, FOLDER).collect():
        text = texts[r["doc_id"]]
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - 199):
            if seen[hash(text[i : i + 200])] > 1:
                gone[i : i + 200] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        got = (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
        assert got == (len(text), int(gone.sum()), spans, sha256(kept).hexdigest())
