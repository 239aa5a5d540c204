"""Token totals by source, language and tokenizer version, kept up by signed deltas.

A change is an insert, a delete or a revision of one document's count under one tokenizer version. A batch of changes is
summed to one signed row per group before it meets the state, so a commit costs the batch and the groups, not the documents.

State lives in a folder that the cluster shares. A commit writes the new totals to a place of its own and publishes them under the next number
(``sinks/versions.py``), which one writer only can take: of two commits at once the later one adds its batch to the totals the
other left. A commit that broke off published nothing, and repeating it is safe. A published batch leaves a mark under its name; that of
the newest state is made good by whoever comes next, so a batch that is in the totals is never added again. A commit reads the newest
state and one mark, however many batches there were.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burstline.llm.common import new_path, table, written
from burstline.llm.pieces import encoded
from burstline.sinks.versions import State, Versions

KEYS = ["source", "lang", "tokenizer"]
STATE = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def signed(changes: DataFrame) -> DataFrame:
    """One row per group of a batch: changes of ``n_docs`` and ``n_tokens``.

    ``changes``: op (insert, delete or revise), source, lang, tokenizer, n_tokens (a deleted document's count; the new count of a
    revision) and old_tokens (of a revision). Null counts are 0, null keys are a group; any other op fails.
    """
    n, old = F.coalesce("n_tokens", F.lit(0)), F.coalesce("old_tokens", F.lit(0))
    known = F.col("op").isin("insert", "delete", "revise")
    wrong = F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("op", F.lit("null")))).cast("long")
    return changes.select(
        *[F.col(k).cast("string").alias(k) for k in KEYS],
        F.when(F.coalesce(known, F.lit(False)), F.when(F.col("op") == "insert", 1).when(F.col("op") == "delete", -1).otherwise(0)).otherwise(wrong).cast("long").alias("docs"),
        F.when(F.col("op") == "insert", n).when(F.col("op") == "delete", -n).otherwise(n - old).cast("long").alias("tokens"),
    ).groupBy(*KEYS).agg(F.sum("docs").alias("n_docs"), F.sum("tokens").alias("n_tokens"))


class Rollup:
    """Totals in ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.versions = spark, Versions(spark, folder)

    def totals(self, state: State | None = None) -> DataFrame:
        """The groups that have documents or tokens; no rows before the first commit."""
        place = (state or self.versions.current()).content.get("totals")
        return self.versions.rows([place] if place else [], STATE)

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch. False if it was added before."""
        name = hashlib.sha256(batch.encode()).hexdigest()
        added = written(signed(changes), "batch")

        def work(now: State) -> dict:
            if now.number:
                self.versions.mark(now.content["batch"])
            if self.versions.marked(name):
                raise Known(batch)
            both = self.totals(now).unionByName(added)
            summed = both.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
            place = self.versions.fresh("totals")
            summed.where("n_docs <> 0 or n_tokens <> 0").write.parquet(place)
            return {"totals": place, "batch": name}

        try:
            self.versions.change(work)
        except Known:
            return False
        self.versions.mark(name)
        return True


class Known(Exception):
    """The batch is in the totals."""


def op5_token_rollup(spark, sf_dir: str) -> DataFrame:
    """All documents inserted under two tokenizer versions, all counts of one revised, toxic documents deleted, one batch sent twice."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    pieces = encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), ["n_tokens"])
    counts = written(pieces.select("doc_id", "source", "lang", F.col("n_tokens").alias("pieces"), F.size(
        F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long").alias("words")).fillna(0, ["words"]), "token-counts")
    of = lambda op, name, n, old: counts.select(
        F.lit(op).alias("op"), "doc_id", "source", "lang", F.lit(name).alias("tokenizer"), n.alias("n_tokens"), old.cast("long").alias("old_tokens"))
    none = F.lit(None)
    first = of("insert", "piece_bpe_32k", F.col("pieces") - 2, none).unionByName(of("insert", "words", F.col("words"), none))
    # The new version counts the begin and end ids as well.
    revised = of("revise", "piece_bpe_32k", F.col("pieces"), F.col("pieces") - 2)
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct()
    gone = of("delete", "piece_bpe_32k", F.col("pieces"), none).unionByName(of("delete", "words", F.col("words"), none)).join(toxic, "doc_id", "left_semi")
    rollup = Rollup(spark, new_path(spark, "rollup"))
    for name, changes in (("insert", first), ("revise", revised), ("delete", gone), ("revise", revised)):
        rollup.commit(name, changes)
    return rollup.totals()
