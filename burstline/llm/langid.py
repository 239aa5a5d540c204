"""Language of a text by Bayesian fusion of what the text, its markup and its address say.

* text: log likelihood of its letter trigrams (hashed) under each language, tempered because trigrams overlap;
* declared language and address suffix: P(value | language), from sums of text posteriors grouped by value;
* host: P(language | host), the host's summed text posteriors without the row's own, smoothed by those of its domain,
  and these by all rows.

The trigram tables are fitted on a bounded sample of the labelled documents of each language; every language among the labels has one. All sums are grouped aggregates over all rows;
a host or value with a third of the rows is summed in parts first, and lookups are broadcast only when counted to be small.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import hinted, pieces_of, table
from burstline.llm.url_filter import url_host

SAMPLE = 1_000  # labelled documents of each language that fit its trigram table
SAMPLE_BYTES = 100_000  # of a document that may be in the sample
BUCKETS = 1 << 15
TEMPER = 0.25
STRENGTH = 5.0  # rows that a host's (a domain's) parent counts for
LEAST = 0.5  # posterior below which a row is rejected
RUN = 200_000

LETTERS = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def grams(text: str | None) -> np.ndarray:
    """Hashed trigrams of the letters of a text, words framed by blanks; none without letters."""
    words = (text or "").encode().translate(LETTERS).split()
    if not words:
        return np.zeros(0, dtype=np.int64)
    data = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
    return ((data[:-2] * 65599 + data[1:-1] * 257 + data[2:]) * 2654435761 >> 12) & (BUCKETS - 1)


def _counted(batches):
    import pyarrow as pa

    for batch in pieces_of(batches):
        for lang in set(batch.column("lang").to_pylist()):
            some = [t for t, own in zip(batch.column("_text").to_pylist(), batch.column("lang").to_pylist()) if own == lang]
            total = np.zeros(BUCKETS, dtype=np.int64)
            for text in some:
                total += np.bincount(grams(text), minlength=BUCKETS)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(total[at])], names=["lang", "gram", "n"])


class TextModel:
    """Languages and log P(trigram | language); without training rows one language, 'und'."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages or ["und"]
        counts = counts if languages else np.zeros((1, BUCKETS))
        self.logs = np.ascontiguousarray(np.log((counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * BUCKETS)).T.astype(np.float32))

    def evidence(self, text: str | None) -> list[float]:
        """Tempered log likelihoods, the largest 0; all 0 without letters. One more number: the trigrams."""
        at = grams(text)
        total = np.zeros(len(self.languages))
        for low in range(0, len(at), RUN):
            total += self.logs[at[low : low + RUN]].sum(0, dtype=np.float64)
        return [*((total - total.max()) * TEMPER).tolist(), float(len(at))]


def trained(labelled: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> TextModel:
    """A text model from about ``sample`` rows of each language with text, or all if they are fewer, picked by the hash of id and text."""
    rows = labelled.select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").cast("string").alias("_text"), F.col(f"`{id_column}`").cast("string").alias("id"))
    some = rows.where(F.col("lang").isNotNull() & (F.octet_length("_text") <= SAMPLE_BYTES))
    scale = 1 << 40
    shares = some.groupBy("lang").agg(F.count("*").alias("rows")).select("lang", (scale * F.lit(float(sample)) / F.col("rows")).alias("share"))
    picked = (
        some.join(hinted(shares.persist(), 64), "lang").where(F.pmod(F.xxhash64("id", "_text"), F.lit(scale)) < F.col("share")).select("lang", "_text")
    )
    got = picked.mapInArrow(_counted, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    # BUCKETS rows for each language at most.
    languages = sorted(set(got.column("lang").to_pylist()))
    place = {name: k for k, name in enumerate(languages)}
    counts = np.zeros((len(languages), BUCKETS))
    counts[[place[name] for name in got.column("lang").to_pylist()], got.column("gram").to_numpy()] = got.column("n").to_numpy()
    return TextModel(languages, counts)


def _softmax(scores: np.ndarray) -> np.ndarray:
    parts = np.exp(scores - scores.max(axis=1, keepdims=True))
    return parts / parts.sum(axis=1, keepdims=True)


def _sums(rows: DataFrame, key: str, column: str, count: int, name: str) -> DataFrame:
    """The summed text posteriors of each value of ``key``, as an array; broadcast if they are counted to be small."""
    sums = rows.groupBy(key).agg(F.array(*[F.sum(F.col(column)[k]) for k in range(count)]).alias(name))
    return hinted(sums.persist(), 8 * count + 128)


def fused(text: np.ndarray, own: np.ndarray, letters: np.ndarray, host: np.ndarray, domain: np.ndarray, named: np.ndarray, whole: np.ndarray,
          values: list[tuple[np.ndarray, np.ndarray, int]], strength: float = STRENGTH) -> np.ndarray:
    """log of the evidence of each row (rows by languages), up to a constant per row.

    ``text``: log likelihoods; ``own``: the text posteriors that are in the sums of ``host`` and ``domain`` and are taken out again;
    ``named``: whether there is a host; ``whole``: the share of each language; ``values``: for every other evidence the sums of
    the row's value, of all rows, and the number of values.
    """
    own = own * letters[:, None]
    above = np.maximum(domain - own, 0) + strength * whole
    above /= above.sum(1, keepdims=True)
    prior = np.maximum(host - own, 0) + strength * above
    prior /= prior.sum(1, keepdims=True)
    out = text + np.log(np.where(named[:, None], prior, whole))
    for sums, total, count in values:
        out = out + np.log((sums + 1) / (total + count + 1))
    return out


def identify(rows: DataFrame, model: TextModel, text: Column, declared: Column, host: Column, least: float = LEAST) -> DataFrame:
    """All rows and columns with ``text_lang``, ``language``, ``confidence`` and ``accepted``; columns of these names are replaced.

    ``declared`` and ``host`` may be null or empty: that is a value like any other for the first, and no host for the second.
    Rows without letters have no ``text_lang``. A row is accepted if it has letters and its confidence is at least ``least``.
    """
    new = ("text_lang", "language", "confidence", "accepted")
    kept = [c for c in rows.columns if c not in new]
    count, names = len(model.languages), model.languages
    send = rows.sparkSession.sparkContext.broadcast(model)

    def seen_in(column: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text: log likelihoods, posteriors, and whether it has letters."""
        got = np.array([send.value.evidence(t) for t in column]).reshape(-1, count + 1)
        return got[:, :count], _softmax(got[:, :count]), got[:, count] > 0

    # Not deterministic to the optimizer: it would run them once for a filter and again for the column.
    def posteriors(column: pd.Series) -> pd.Series:
        """The posteriors of each text; null without letters, which say nothing about their host."""
        _, own, letters = seen_in(column)
        return pd.Series([p if some else None for p, some in zip(own, letters)])

    posteriors = F.pandas_udf(posteriors, "array<double>").asNondeterministic()
    clean_host = F.lower(F.coalesce(host, F.lit("")))
    labels = F.split("host", r"\.", -1)
    seen = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), clean_host.alias("host"), F.lower(F.coalesce(declared, F.lit(""))).alias("declared"), text.alias("said"),
    ).withColumns({
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)), "suffix": F.element_at(labels, -1),
    })
    # One row per distinct address and declaration.
    address = ("host", "domain", "suffix", "declared")
    p = F.array(*[F.sum(F.col("e")[k]) for k in range(count)])
    groups = seen.select(*address, posteriors("said").alias("e")).where("e is not null").groupBy(*address).agg(p.alias("p")).persist()
    totals = groups.agg(
        F.array(*[F.sum(F.col("p")[k]) for k in range(count)]).alias("p"), F.countDistinct("declared").alias("declared"), F.countDistinct("suffix").alias("suffix"),
    ).first()
    total = np.array([x or 0.0 for x in totals["p"]])
    whole = (total + 1) / (total + 1).sum()
    size = {"declared": totals["declared"], "suffix": totals["suffix"]}

    def decide(said: pd.Series, host: pd.Series, host_sums: pd.Series, domain_sums: pd.Series, declared_sums: pd.Series, suffix_sums: pd.Series) -> pd.Series:
        """The languages by text and by all evidence, the confidence in the latter, and whether there are letters."""
        known = lambda sums: np.array([np.zeros(count) if x is None else np.asarray(x) for x in sums]).reshape(-1, count)
        logs, own, letters = seen_in(said)
        named = (host != "").to_numpy()
        suffix = np.where(named[:, None], known(suffix_sums), (total + size["suffix"] + 1) - 1)
        post = _softmax(fused(logs, own, letters, known(host_sums), known(domain_sums), named, whole, [
            (known(declared_sums), total, size["declared"]), (suffix, total, size["suffix"]),
        ]))
        return pd.Series(list(np.stack([logs.argmax(1), post.argmax(1), post.max(1), letters], axis=1)))

    decide = F.pandas_udf(decide, "array<double>").asNondeterministic()
    joined = seen
    for key, mark in (("host", "h"), ("domain", "d"), ("declared", "l"), ("suffix", "x")):
        joined = joined.join(_sums(groups, key, "p", count, mark), key, "left")
    done = joined.select("row", decide("said", "host", "h", "d", "l", "x").alias("best")).withColumn("letters", F.col("best")[3] > 0)
    name = lambda k: F.array(*map(F.lit, names))[F.col("best")[k].cast("int")]
    return done.select(
        *[F.col(f"row.`{c}`").alias(c) for c in kept], F.when(F.col("letters"), name(0)).alias("text_lang"), name(1).alias("language"),
        F.col("best")[2].alias("confidence"), (F.col("letters") & (F.col("best")[2] >= least)).alias("accepted"),
    )


def visible_text(html: Column) -> Column:
    """What stands outside scripts, styles, comments and tags."""
    return F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->|<[^>]*>", " ")


def declared_language(html: Column) -> Column:
    return F.lower(F.regexp_extract(html, r"""(?is)<html\b[^>]*?\slang\s*=\s*["']?([A-Za-z]+)""", 1))


def op4_language(spark, sf_dir: str) -> DataFrame:
    model = trained(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = identify(pages, model, visible_text(F.col("html")), declared_language(F.col("html")), url_host(F.col("url")))
    return found.select("page_id", "text_lang", "language", "confidence", "accepted")
