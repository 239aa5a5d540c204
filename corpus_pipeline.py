"""The corpus pipeline: raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents. Between stages ``run`` writes the rows to the cluster's shared folder and reads them again, so that a lost
executor never costs more than the stage at hand.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm import decontaminate, langid, near_dup, pieces, quality
from burstline.llm.common import prepare, table, written

LEAST_SIMILAR = 80  # of 100: documents as similar as this, by runs of five words, are near-duplicates here


def with_own_columns(docs: DataFrame, names: tuple[str, ...], work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on the documents, whose own columns of the names it uses stay out of its way and come back as they were."""
    away = {c: f"_own_{c}" for c in docs.columns if c in names}
    done = work(docs.withColumnsRenamed(away))
    return done.select(*[F.col(f"`{away.get(c, c)}`").alias(c) for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the attention classifier, trained on their labels, does not reject."""
    prepare(spark)
    model = quality.trained(docs, table(spark, sf_dir, "labels"))
    return with_own_columns(docs, ("score",), lambda own: quality.scored(own, model).where(F.col("score") >= quality.THRESHOLD))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose language the evidence agrees well enough; ``lang`` stays as declared."""
    prepare(spark)
    model = langid.trained(docs)
    new = ("text_lang", "language", "confidence", "accepted")
    return with_own_columns(
        docs, new, lambda own: langid.identify(own, model, F.col("text"), F.col("lang"), F.col("source")).where("accepted")
    )


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; see ``near_dup.first_of_each``."""
    prepare(spark)
    return with_own_columns(docs, ("row_key", "kept", "n"), lambda own: near_dup.first_of_each(own, percent=LEAST_SIMILAR))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of the benchmark; those that are mostly benchmark go."""
    prepare(spark)
    clean = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text with begin and end id, and digests of the ids and of the text they decode to."""
    prepare(spark)
    model = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.encoded(docs, model, ["ids", "n_tokens", "ids_sha256", "decoded_sha256"], keep=["doc_id"])


STAGES = [
    ("quality", good_quality), ("language", known_language), ("near_duplicates", one_of_each), ("benchmark", no_benchmark), ("tokens", token_ids),
]

# Trained models, tokenizers and sketches are beyond SQL: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
