"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language, merkle, packing, toxicity, whitening
from .bpe import token_digests
from .common import ascii_lower, fold, table
from .decontaminate import contaminated
from .exact_dedup import duplicate_groups
from .pii import pseudonymised
from .quality import assess, train
from .repeats import repeated_spans
from .simhash import near_duplicates
from .warc import archived

#: Vocabulary file of the token queries.
VOCABULARY = "word_bpe_49k.json"
#: Vocabulary file of the packing query.
BYTES = "byte_bpe_50k.json"
#: Key of the registered query only; a real one comes from a secret store.
KEY = "registered query"


def op1_suffix_arrays(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans(table(spark, folder, "documents"))


def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = train(docs, table(spark, folder, "labels"))
    rated = assess(docs, model, host=F.col("source"), path=F.col("lang"))
    names = {"__p": "evidence", "__host_rate": "host_rate", "__path_rate": "path_rate", "__score": "score", "__keep": "kept"}
    return rated.select("doc_id", *(F.col(a).alias(b) for a, b in names.items()))


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_groups(table(spark, folder, "documents"))


def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(table(spark, folder, "documents"), public_tokenizers.path(VOCABULARY))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archived(table(spark, folder, "pages"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonymised(table(spark, folder, "documents"), KEY).select("doc_id", "text", "n_private")


def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = language.train(docs.filter(fold("doc_id", 4) != 2))
    return language.identified(docs, model).withColumn("held_out", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)))


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.train(docs, table(spark, folder, "labels").filter(fold("doc_id", 5) != 0))
    return toxicity.scored(docs, model).withColumn("held_out", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    model = whitening.fit(vectors)
    n, error, shares = (model.n, model.identity_error, model.explained.tolist()) if model else (0, 0.0, [0.0])
    rows = whitening.whitened(vectors, model).select("*", F.posexplode("whitened").alias("place", "value"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.element_at(F.array(*map(F.lit, shares)), F.col("place") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
        "deviation_text",
    )


def op12_merkle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    changed = [ascii_lower(F.col(c)) if c == "text" else F.col(c) for c in merkle.FIELDS]
    altered = F.when(fold("doc_id", 3) == 0, merkle.leaf_digest(changed))
    found = merkle.proofs(merkle.manifest(docs, altered=altered))
    refolded = merkle.folded(F.coalesce("altered", "leaf"), F.col("path"))
    shown = found.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", merkle.path_digest(F.col("path")).alias("proof_sha256"), refolded.alias("folded_root")
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.packed(table(spark, folder, "documents"), public_tokenizers.path(BYTES))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES = {
    "op1_suffix_arrays": op1_suffix_arrays,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_simhash": op4_simhash,
    "op5_bpe": op5_bpe,
    "op6_warc": op6_warc,
    "op7_decontamination": op7_decontamination,
    "op8_pii": op8_pii,
    "op9_language": op9_language,
    "op10_toxicity": op10_toxicity,
    "op11_whitening": op11_whitening,
    "op12_merkle": op12_merkle,
    "op13_packing": op13_packing,
}
