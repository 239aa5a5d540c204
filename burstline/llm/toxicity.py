"""Toxicity by the nearest labelled examples.

Texts are compared by the TF-IDF cosine of their terms: runs of 4 to 6 characters in case-folded words (blanks at the ends are
characters of a word), and whole words. The vocabulary are the terms that tell toxic from other examples by a chi-squared test; without
that, cosines of long texts say how alike their filler is. Examples are a bounded sample of labelled documents for each label.

The index over the examples is inverted, its postings cut in blocks of examples, and each term knows its greatest weight in each
block. A query adds these up to an upper bound for every block and scores whole blocks from the highest bound down, until the next bound is
below its k-th best cosine: the k nearest are exact, ties by the order of the examples.

The neighbours of either label vote with weights that fall with their distance, so a text that is far from all of them has few votes of any kind. The
two sums become a probability by a logistic curve, fitted on the examples themselves with each left out of its own neighbours, each counting for as many
documents as its label's sample stands for. Of equal texts one is an example. A text without any term of the vocabulary has
no neighbours; its score is the share of toxic documents among examples without terms. The index is broadcast (bounded by the sample), texts stay in the
tasks that read them, and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.llm.common import bounded_sample, kept, pieces_of, table, with_text

SAMPLE = 3_000  # labelled examples of each label
SAMPLE_BYTES = 100_000  # of a document that may be an example
SHORTEST, LONGEST = 4, 6  # characters of a run
LONGEST_WORD = 40  # of a word that is a term itself
LEAST_DOCS, LEAST_CHI = 3, 25.0
LEAST_SHARE = 0.01  # of the examples of a label: a term in fewer of either comes from a few texts copied with small changes
VOCABULARY = 4_096
BLOCK = 64  # examples
WAVE = 8  # blocks scored at once
NEIGHBOURS = 15
NEAR = 0.05  # added to distances, so that equal texts have a finite vote
FEW = 0.02  # votes added to either sum: below it, differences tell little
PENALTY = 0.1
THRESHOLD = 0.7
PART = 1 << 18  # characters of a text looked at at once

EVIDENCE = T.ArrayType(T.StructType().add("id", "long").add("label", "integer").add("cosine", "double"))
NO_LETTERS = re.compile(r"[\W\d_]+")


def words_only(text: str) -> str:
    """Case-folded words with a blank in place of whatever is between."""
    return NO_LETTERS.sub(" ", text.casefold())


def parts_of(text: str, most: int = PART, overlap: int = LONGEST_WORD + 2) -> Iterator[tuple[str, int]]:
    """The words of a text in parts, each with the number of its own characters: behind those it shows the start of the next."""
    padded = f" {text} "
    for low in range(0, len(padded), most):
        own = words_only(padded[low : low + most])
        yield own + words_only(padded[low + most : low + most + overlap]), len(own)


def terms_of(text: str) -> set[str]:
    """All terms of a text. A word longer than LONGEST_WORD has runs, but is no term itself."""
    found = set()
    for word in set(words_only(text).split()):
        marked = f" {word} "
        if len(word) <= LONGEST_WORD:
            found.add(marked)
        for size in range(SHORTEST, LONGEST + 1):
            found.update(marked[k : k + size] for k in range(len(marked) - size + 1))
    return found


class Terms:
    """Counts of the vocabulary's terms in texts, all in one pass over a text."""

    def __init__(self, vocabulary: list[str]):
        self.trie = ahocorasick.Automaton()
        for number, term in enumerate(vocabulary):
            self.trie.add_word(term, (number, len(term) - 1))
        self.trie.make_automaton()
        self.any = bool(vocabulary)

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the terms in a text, ascending, and how often each occurs."""
        found: Counter[int] = Counter()
        if text and self.any:
            for part, own in parts_of(text):
                found.update(number for end, (number, back) in self.trie.iter(part) if end - back < own)
        terms = np.array(sorted(found), dtype=np.int64)
        return terms, np.array([found[t] for t in terms.tolist()], dtype=np.int64)


class BlockMaxIndex:
    """Postings of unit vectors by term and block, and each term's greatest weight in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], vocabulary: int, block: int = BLOCK):
        self.size, self.block = len(vectors), block
        self.blocks = -(-self.size // block)
        # Examples of one heaviest term side by side: a term's weights lie in few blocks.
        heaviest = [int(t[np.argmax(w)]) if len(t) else -1 for t, w in vectors]
        self.order = np.argsort(heaviest, kind="stable")
        place = np.empty(self.size, np.int64)
        place[self.order] = np.arange(self.size)
        term = np.concatenate([np.zeros(0, np.int64), *(t for t, _ in vectors)])
        weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        at = np.repeat(place, [len(t) for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        cell = term * self.blocks + at // block
        by_cell = np.lexsort((at, cell))
        self.at, self.weight = at[by_cell], weight[by_cell]
        # Postings of term t in block b are start[t * blocks + b] up to the next.
        self.start = np.searchsorted(cell[by_cell], np.arange(vocabulary * self.blocks + 1))
        self.greatest = np.zeros(vocabulary * self.blocks)
        np.maximum.at(self.greatest, cell, weight)
        self.greatest = self.greatest.reshape(vocabulary, self.blocks)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, int]:
        """The k examples of highest cosine above 0, best first, ties by their number; their cosines; and how many blocks were scored.

        Examples numbered in ``without`` are passed over.
        """
        found, cosine, scored = np.zeros(0, np.int64), np.zeros(0), 0
        if not len(terms) or not self.size:
            return found, cosine, scored
        bound = weights @ self.greatest[terms]
        order = np.argsort(-bound, kind="stable")
        for low in range(0, self.blocks, WAVE):
            wave = order[low : low + WAVE]
            if bound[wave[0]] <= 0 or len(found) == k and bound[wave[0]] < cosine[-1] - 1e-9:
                break
            cell = (terms[:, None] * self.blocks + wave[None]).reshape(-1)
            first, count = self.start[cell], self.start[cell + 1] - self.start[cell]
            places = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            own = np.repeat(np.tile(np.arange(len(wave)) * self.block, len(terms)), count) + self.at[places] % self.block
            sums = np.bincount(own, weights=np.repeat(np.repeat(weights, len(wave)), count) * self.weight[places], minlength=len(wave) * self.block)
            hit = np.flatnonzero(sums)
            number, value = self.order[wave[hit // self.block] * self.block + hit % self.block], sums[hit]
            if without is not None:
                other = ~np.isin(number, without)
                number, value = number[other], value[other]
            # Rounded, so that equal vectors tie however their sums were formed.
            number, value = np.concatenate([found, number]), np.concatenate([cosine, np.round(value, 12)])
            best = np.lexsort((number, -value))[:k]
            found, cosine, scored = number[best], value[best], scored + len(wave)
        return found, cosine, scored


@dataclass
class Model:
    """Examples in an index, and the curve from votes to probabilities."""

    vocabulary: list[str]
    idf: np.ndarray
    index: BlockMaxIndex
    ids: np.ndarray
    labels: np.ndarray
    without_terms: float
    slopes: np.ndarray
    neighbours: int = NEIGHBOURS

    def vector(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return unit_weights(terms, counts, self.idf)

    def votes(self, near: np.ndarray, cosine: np.ndarray) -> np.ndarray:
        """Votes for toxic and for other, by nearness: as logarithms, and the 1 of the curve's shift."""
        weight = cosine / (1 - np.minimum(cosine, 1) + NEAR) / self.neighbours
        toxic = self.labels[near] == 1
        return np.array([np.log(FEW + weight[toxic].sum()), np.log(FEW + weight[~toxic].sum()), 1.0])

    def score(self, terms: np.ndarray, counts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        near, cosine, _ = self.index.nearest(terms, self.vector(terms, counts), self.neighbours)
        if not len(near):
            return self.without_terms, near, cosine
        return float(_sigmoid(self.votes(near, cosine) @ self.slopes)), near, cosine


def unit_weights(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(np.maximum(counts, 1))) * idf[terms]
    return weight / max(float(np.linalg.norm(weight)), 1e-300)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def curve(votes: np.ndarray, labels: np.ndarray, weights: np.ndarray, turns: int = 60) -> np.ndarray:
    """Slopes of a logistic curve from votes (rows of toxic, other, 1) to labels, by damped Newton steps on the weighted log loss.

    A small penalty keeps them finite where votes separate the labels. Votes for toxic never lower a score, those for other never lift it.
    """
    at = np.array([1.0, -1.0, 0.0])
    for _ in range(turns):
        p = _sigmoid(votes @ at)
        gradient = votes.T @ (weights * (p - labels)) + PENALTY * at
        hessian = (votes * (weights * p * (1 - p))[:, None]).T @ votes + PENALTY * np.eye(3)
        step = np.linalg.solve(hessian, gradient)
        at = at - step * min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-12))
        at[0], at[1] = max(at[0], 0.0), min(at[1], 0.0)
    return at


def held_out(id_column: str = "doc_id") -> Column:
    """The rows that never teach; a row without id may."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 3 == 1, F.lit(False))


def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of a batch hold each term."""
    for batch in pieces_of(batches):
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for label, text in zip(batch.column("label").to_pylist(), batch.column("_text").to_pylist()):
            counts[label].update(terms_of(text))
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()), pa.array([counts[0][t] for t in terms], pa.int64())],
            names=["term", "toxic", "other"])


def _example_vectors(vocabulary: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(vocabulary)
        for batch in pieces_of(batches):
            found = [terms.counts(text) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label")), *(pa.array([x[k].tolist() for x in found], pa.list_(pa.int64())) for k in (0, 1))],
                names=["id", "label", "terms", "counts"])

    return run


def telling_terms(examples: DataFrame, toxic: int, other: int, most: int = VOCABULARY) -> list[tuple[str, int]]:
    """Terms that tell the labels apart, with the number of examples that hold them: highest chi-squared first, ties by the term."""
    n = toxic + other
    counts = examples.select("label", "_text").mapInArrow(_term_counts, "term string, toxic long, other long").groupBy("term").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum("other").cast("double").alias("b"))
    docs = F.col("a") + F.col("b")
    cross = F.col("a") * F.lit(float(other)) - F.col("b") * F.lit(float(toxic))
    chi = F.lit(float(n)) * cross * cross / (F.lit(float(toxic) * float(other)) * docs * (F.lit(float(n)) - docs))
    often = F.greatest(F.col("a") / F.lit(float(toxic)), F.col("b") / F.lit(float(other))) >= LEAST_SHARE
    chosen = counts.where((docs >= LEAST_DOCS) & often).withColumn("chi", F.when(docs < n, chi)).where(F.col("chi") >= LEAST_CHI)
    return [(r["term"], int(r["a"] + r["b"])) for r in chosen.orderBy(F.col("chi").desc(), "term").limit(most).collect()]


def trained(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
            neighbours: int = NEIGHBOURS) -> Model:
    """A model from about ``sample`` labelled documents of each label that are not held out, picked by the hash of their id.

    Labels other than 0 and 1, ids with both, and texts of more than SAMPLE_BYTES are passed over, and so are equal texts with both; of documents that repeat an id each counts. With no examples
    of one label nothing tells the labels apart, and every score is the share of toxic examples, 0.5 without any.
    """
    clean = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where("id is not null and label in (0, 1)")
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
        .where(~held_out("id")).select("id", "label")
    )
    picked = [bounded_sample(clean.where(F.col("label") == k), F.col("id").cast("string"), sample) for k in (0, 1)]
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("_text"))
    short = rows.where(F.octet_length("_text") <= SAMPLE_BYTES).join(F.broadcast(picked[0].union(picked[1])), "id")
    # Ids may repeat among the documents.
    some = bounded_sample(short, F.col("_text"), 4 * sample)
    examples = kept(some.groupBy("_text").agg(F.min("id").alias("id"), F.min("label").alias("label"), F.max("label").alias("other"))
                    .where("label = other").drop("other"))
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}
    known = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    telling = telling_terms(examples, sizes.get(1, 0), sizes.get(0, 0)) if len(sizes) == 2 else []
    got = examples.select("id", "label", "_text").mapInArrow(
        _example_vectors([t for t, _ in telling]), "id long, label int, terms array<long>, counts array<long>").orderBy("id", "terms", "counts").toArrow()
    examples.unpersist()
    return fit(telling, got, {k: known.get(k, 0) / n for k, n in sizes.items()}, neighbours)


def fit(telling: list[tuple[str, int]], examples: pa.Table, stands_for: dict[int, float], neighbours: int) -> Model:
    labels = np.array(examples.column("label").to_pylist(), dtype=np.int64)
    each = np.array([stands_for[k] for k in labels.tolist()])
    found = [(np.array(t, dtype=np.int64), np.array(c, dtype=np.int64)) for t, c in zip(examples.column("terms").to_pylist(), examples.column("counts").to_pylist())]
    idf = np.log((1 + len(found)) / (1 + np.array([n for _, n in telling], dtype=float))) + 1
    some = np.array([len(t) > 0 for t, _ in found], dtype=bool)
    bare = each[~some]
    # One document more, half of it toxic: no share is 0 or 1.
    without = (float((bare * labels[~some]).sum()) + 0.5) / (float(bare.sum()) + 1)
    vectors = [(t, unit_weights(t, c, idf)) for t, c in (found[k] for k in np.flatnonzero(some))]
    ids, own = np.array(examples.column("id").to_pylist(), dtype=np.int64)[some], labels[some]
    model = Model([t for t, _ in telling], idf, BlockMaxIndex(vectors, len(telling)), ids, own, without, np.zeros(3), neighbours)
    votes, seen = [], []
    for place, vector in enumerate(vectors):
        near, cosine, _ = model.index.nearest(*vector, neighbours, np.array([place]))
        if len(near):
            seen.append(place)
            votes.append(model.votes(near, cosine))
    if seen:
        model.slopes = curve(np.array(votes), own[seen].astype(float), each[some][seen])
    return model


def _scorer(model, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        use = model.value
        terms = Terms(use.vocabulary)
        for batch in pieces_of(batches, text):
            scores, evidence = [], []
            for one in batch.column(text):
                score, near, cosine = use.score(*terms.counts(one.as_py()))
                scores.append(score)
                evidence.append([{"id": i, "label": k, "cosine": c} for i, k, c in zip(use.ids[near].tolist(), use.labels[near].tolist(), cosine.tolist())])
            own = batch.select(keep)
            kind = pa.list_(pa.struct([("id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(scores, pa.float64()), pa.array(evidence, kind)], names=[*own.schema.names, "score", "evidence"])

    return run


def scored(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with the columns ``keep`` (all), ``score`` (0 to 1) and ``evidence``: the nearest examples, best first.

    A null text is empty; an empty text, and one without any term of the vocabulary, has no evidence. Columns of those names are replaced.
    """
    own = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "evidence")]
    rows, name = with_text(docs, own, text)
    send = docs.sparkSession.sparkContext.broadcast(model)
    schema = rows.select(*[F.col(f"`{c}`") for c in own]).schema.add("score", "double").add("evidence", EVIDENCE)
    return rows.mapInArrow(_scorer(send, name, own), schema)


def op13_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"), "evidence")
