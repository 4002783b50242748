import glob
import os
import re


import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from accountpulse.llm import bpe, decontaminate
from accountpulse.llm.common import table
from accountpulse.llm.oracle import ORACLE
from accountpulse.llm.queries import QUERIES, VOCABULARY
from checks.compare import connect, differences

from . import awkward
from .test_dedup import fingerprint, grouped, lowered

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries(spark, name):
    """Against SQL where there is some; else one row per input row, or at least none that fails."""
    found = QUERIES[name](spark, FOLDER)
    if name in ORACLE:
        assert differences(found, connect(FOLDER), ORACLE[name]) is None
    elif name in ("op11_whitening", "op13_packing"):
        assert found.count() > table(spark, FOLDER, "documents" if name == "op13_packing" else "embeddings").count()
    elif name != "op7_decontamination":
        assert found.count() == table(spark, FOLDER, "documents").count()
    else:
        docs = {r["doc_id"]: decontaminate.normalised(r["text"]) for r in table(spark, FOLDER, "documents").collect()}
        items = {r["item_id"]: decontaminate.normalised(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()}
        exact = {(d, i) for d, t in docs.items() for i, b in items.items() if b in t}
        assert exact <= {(r["doc_id"], r["item_id"]) for r in found.collect()}


def test_number_of_stages_and_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]


def test_stages_against_brute_force(spark):
    """Each stage judged on its own input."""
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    docs = table(spark, FOLDER, "documents")
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, spark.createDataFrame([r for r in docs.collect()], docs.schema), FOLDER)
        rows = out.collect()
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(after) and after.items() <= before.items()
        if name == "quality":
            wrong = [k for k in before if k in labels and labels[k] != (k in after)]
            assert len(wrong) <= 0.03 * len(labels)
        elif name == "exact_dedup":
            last = {}
            for k, t in before.items():
                last[lowered(t)] = max(k, last.get(lowered(t), k))
            assert set(after) == set(last.values())
        elif name == "near_dedup":
            roots = grouped({fingerprint(t) for t in before.values()})
            least = {}
            for k, t in before.items():
                root = roots[fingerprint(t)]
                least[root] = min(k, least.get(root, k))
            assert set(after) == set(least.values())
        elif name == "decontamination":
            items = [decontaminate.normalised(r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
            clean = {k for k, t in before.items() if not any(i in decontaminate.normalised(t) for i in items)}
            assert set(after) <= clean and len(clean - set(after)) <= 1
        else:
            for r in rows:
                assert r["tokens"] == library.encode(r["text"], add_special_tokens=False).ids
        assert name == "tokens" or out.columns == docs.columns
        docs, before = spark.createDataFrame(rows, out.schema), after


def test_no_stage_reads_less(spark):
    """No row limits, samples or local checkpoints in the operators."""
    here = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for path in [*glob.glob(f"{here}/accountpulse/llm/*.py"), f"{here}/corpus_pipeline.py"]:
        text = open(path, encoding="utf-8").read()
        assert not re.search(r"localCheckpoint|crossJoin|\.sample\(|tablesample", text, re.I), path
        assert text.count(".limit(") == text.count(".limit(sample)"), path




def test_stages_with_awkward_rows(spark):
    """Nulls, empty and long texts, repeated rows and clashing names in every stage that works row by row."""
    rows = awkward.documents()
    docs = awkward.frame(spark, rows)
    library = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    coded = bpe.tokenized(docs, public_tokenizers.path(VOCABULARY), decoded=True)
    assert coded.columns == [*docs.columns, "tokens", "decoded_sha256"]
    got = sorted((str(r["doc_id"]), str(r["text"]), tuple(r["tokens"])) for r in coded.collect())
    assert got == sorted((str(r[0]), str(r[1]), tuple(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows)
    items = spark.createDataFrame([(1, rows[0][1]), (2, None), (3, ""), (4, rows[5][1]), (None, rows[0][1])], "item_id long, text string")
    clean = decontaminate.drop_contaminated(docs, items)
    stays = [r["text"] for r in clean.collect()]
    assert clean.columns == docs.columns and rows[0][1] not in stays and rows[5][1] not in stays
    assert sum(t is None for t in stays) == sum(r[1] is None for r in rows) and "" in stays
    assert decontaminate.drop_contaminated(docs, items.limit(0)).count() == len(rows)
    for function in (lambda d: bpe.tokenized(d, public_tokenizers.path(VOCABULARY)), lambda d: decontaminate.drop_contaminated(d, items)):
        assert function(awkward.empty(spark)).collect() == []
