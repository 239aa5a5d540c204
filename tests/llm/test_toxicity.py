"""Toxicity: the index against all cosines, terms against plain Python, held-out accuracy, odd rows."""

import random
import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from burstline.llm import registry, toxicity as tx

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"


def sparse(rnd, count, vocabulary, most=12):
    vectors = []
    for _ in range(count):
        terms = np.sort(rnd.choice(vocabulary, rnd.integers(1, most), replace=False))
        weight = rnd.integers(1, 4, len(terms)).astype(float)
        vectors.append((terms, weight / np.linalg.norm(weight)))
    return vectors


def all_cosines(vectors, terms, weights):
    dense = dict(zip(terms.tolist(), weights.tolist()))
    return np.round([sum(dense.get(t, 0) * w for t, w in zip(ts.tolist(), ws.tolist())) for ts, ws in vectors], 12)


@pytest.mark.parametrize("count, vocabulary", [(1, 3), (70, 5), (1000, 40), (3000, 400)])
def test_nearest_equal_all_cosines(count, vocabulary):
    rnd = np.random.default_rng(count)
    vectors = sparse(rnd, count, vocabulary, min(12, vocabulary))
    vectors += vectors[: count // 3]  # equal vectors tie
    index = tx.BlockMaxIndex(vectors, vocabulary, block=16)
    for terms, weights in sparse(rnd, 25, vocabulary, min(12, vocabulary)):
        without = rnd.integers(0, len(vectors), 2)
        cosine = all_cosines(vectors, terms, weights)
        cosine[without] = 0
        want = sorted(np.flatnonzero(cosine > 0).tolist(), key=lambda k: (-cosine[k], k))[:10]
        near, got, _ = index.nearest(terms, weights, 10, without)
        assert near.tolist() == want and np.allclose(got, cosine[want], atol=2e-12)


def test_blocks_that_cannot_hold_a_neighbour_are_not_scored():
    rnd = np.random.default_rng(2)
    vectors = [(np.array([k % 50, 50 + k % 7]), np.array([0.9, (1 - 0.81) ** 0.5])) for k in rnd.permutation(6400)]
    index = tx.BlockMaxIndex(vectors, 57, block=64)
    near, cosine, scored = index.nearest(np.array([3, 52]), np.array([0.9, (1 - 0.81) ** 0.5]), 5)
    assert scored <= 16 < index.blocks
    exact = all_cosines(vectors, np.array([3, 52]), np.array([0.9, (1 - 0.81) ** 0.5]))
    assert near.tolist() == sorted(range(6400), key=lambda k: (-exact[k], k))[:5]


def test_terms_in_parts_equal_terms_of_the_whole(monkeypatch):
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choice("abÄßΣİ9_- ") for _ in range(rnd.randint(1, 12))) for _ in range(400))
    whole = tx.terms_of(text)
    vocabulary = sorted(whole)
    padded = tx.words_only(f" {text} ")
    want = {k: sum(padded.startswith(t, i) for i in range(len(padded))) for k, t in enumerate(vocabulary)}
    for size in (7, 64, 1 << 20):
        monkeypatch.setattr(tx.parts_of, "__defaults__", (size, tx.LONGEST_WORD + 2))
        terms, counts = tx.Terms(vocabulary).counts(text)
        assert dict(zip(terms.tolist(), counts.tolist())) == want


def test_curve_follows_the_labels():
    rnd = np.random.default_rng(0)
    votes = np.concatenate([rnd.normal(size=(6000, 2)), np.ones((6000, 1))], axis=1)
    labels = (rnd.random(6000) < tx._sigmoid(votes @ [1.5, -0.5, -1])).astype(float)
    assert np.abs(tx.curve(votes, labels, np.ones(6000)) - [1.5, -0.5, -1]).max() < 0.15
    sure = np.array([[1.0, -3, 1]] * 50 + [[-3, 1.0, 1]] * 50)
    slopes = tx.curve(sure, np.array([1.0] * 50 + [0.0] * 50), np.ones(100))
    assert np.isfinite(slopes).all() and tx._sigmoid(sure[0] @ slopes) > 0.9 > 0.1 > tx._sigmoid(sure[-1] @ slopes)


def test_held_out_documents_are_told_apart(spark):
    rows = registry.queries()["op13_toxicity"](spark, MIDDLE)
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet").select("doc_id", "toxic")
    got = rows.join(labels, "doc_id").where("held_out").collect()
    toxic, other = ([r["predicted"] for r in got if r["toxic"] == k] for k in (1, 0))
    assert sum(toxic) >= 0.7 * len(toxic) and sum(other) <= 0.02 * len(other)


def test_scores_of_the_query_follow_the_contract(spark):
    rows = registry.queries()["op13_toxicity"](spark, SMALL).collect()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert len(rows) == docs and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def made(spark, count=240):
    """Documents of which those with a marked word are labelled toxic, copies among them, ids that repeat and labels that contradict."""
    rnd = random.Random(5)
    docs, labels = [], []
    for k in range(count):
        words = ["".join(rnd.choice("aeioulmnr") for _ in range(rnd.randint(2, 6))) for _ in range(30)]
        toxic = k % 4 == 0
        if toxic:
            words[rnd.randrange(30)] = rnd.choice(["Bozohead", "zz-BOZO!", "grumbag"])
        docs.append((k, " ".join(words), "x"))
        labels.append((k, int(toxic)))
    docs += docs[:10]
    labels += [(1, 1), (2, None), (3, 7), (None, 1), (5, 0), (5, 0)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_evidence_is_the_nearest_labelled_examples(spark):
    docs, labels = made(spark)
    model = tx.trained(docs, labels, neighbours=6)
    taught = {i for i in range(240) if zlib.crc32(str(i).encode()) % 3 != 1} - {1, 2, 3}
    assert set(model.ids.tolist()) <= taught
    asked = spark.createDataFrame([(1, "a BOZOHEAD it is", "own"), (2, "a mild text", "own")], "doc_id long, text string, score string")
    got = {r["doc_id"]: r for r in tx.scored(asked, model).collect()}
    assert got[1]["score"] > 0.7 > 0.3 > got[2]["score"] and len(got[1]["evidence"]) == 6
    assert all(e["label"] == 1 and e["id"] in taught for e in got[1]["evidence"])
    cosines = [e["cosine"] for e in got[1]["evidence"]]
    assert cosines == sorted(cosines, reverse=True) and list(got[2]["evidence"]) == []


def test_odd_rows_have_a_score_each(spark):
    docs, labels = made(spark)
    model = tx.trained(docs, labels)
    long = "ruminal " * 2_000_000 + "grumbag"  # 16 MB, the word that counts at the end
    rows = [(1, None, "a"), (2, "", "b"), (None, "grumbag", "c"), (3, long, "d"), (4, "x" * 3_000_000, "e"), (4, "x" * 3_000_000, "e"), (5, "\u0000 ퟿ 漢字 ", "f")]
    asked = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, _text string, evidence string")
    got = tx.scored(asked, model).collect()
    assert len(got) == 7 and got[0].asDict().keys() == {"doc_id", "text", "_text", "score", "evidence"}
    by = {r["_text"]: r["score"] for r in got}
    assert by["a"] == by["b"] == by["e"] == model.without_terms and by["c"] > 0.7 and by["d"] > 0.7
    assert tx.scored(asked.limit(0), model).count() == 0


@pytest.mark.parametrize("kept, share", [("toxic = 0", 0.0), ("toxic = 1", 1.0), ("false", 0.5)])
def test_without_examples_of_both_labels_every_score_is_their_share(spark, kept, share):
    docs, labels = made(spark)
    model = tx.trained(docs, labels.where(kept))
    scores = {r["score"] for r in tx.scored(docs, model, keep=["doc_id"]).collect()}
    assert len(scores) == 1 and abs(scores.pop() - share) < 0.05
