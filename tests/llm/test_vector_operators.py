"""Vector codes and hard negatives against brute force, with odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from burstline.llm import codes, hard_negatives as hn, registry

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, label int, code string, vector int"


def plain_codes(rows, scale=4096, parts=8, entries=16, rounds=6):
    """Every part compared with every entry in every round, in plain Python."""
    able = [(i, v, lab) for i, v, lab in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    able = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in able]
    able.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not able:
        return [], None
    width = len(able[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in able]
    books = [[cut[e][p] for e in range(min(entries, len(able)))] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        near = [[min(range(len(books[p])), key=lambda e: (far(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]  # noqa: B023
        if turn == rounds:
            break
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [c[p] for c, n in zip(cut, near) if n[p] == e]
                if mine:
                    books[p][e] = [sum(x) // len(mine) for x in zip(*mine)]
    error = [sum(far(c[p], books[p][n[p]]) for p in range(parts)) for c, n in zip(cut, near)]
    by_label = {}
    for (_, _, lab), x in zip(able, error):
        by_label[lab] = by_label.get(lab, 0) + x
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for e in n), x, by_label[lab]) for (i, _, lab), n, x in zip(able, near, error)], digest


def as_rows(rows):
    return [(i, v, lab, "taken", 3) for i, v, lab in rows]


def odd_vectors(count, dim, seed, grain=4):
    """Vectors of few distinct components, so that distances tie, with copies, missing and unusable ones among them."""
    rnd = random.Random(seed)
    rows = [(k, [rnd.randint(-grain, grain) / grain for _ in range(dim)], rnd.choice([0, 0, 0, 1, 2, None])) for k in range(count)]
    rows += rows[5:9]
    rows += [(None, rows[3][1], 1), (count, None, 1), (count + 1, [None] * dim, 1), (count + 2, [float("nan")] * dim, 1), (count + 3, [float("inf")] + [0.0] * (dim - 1), 0),
             (count + 4, [], 2), (count + 5, [0.0] * dim, None)]
    return rows


@pytest.mark.parametrize("count", [0, 1, 5, 60, 300])
def test_codes_equal_whole_scans(spark, count):
    rows = odd_vectors(count, 16, seed=count) if count > 8 else [(k, [k / 7] * 16, None) for k in range(count)]
    got, books = codes.vector_codes(spark.createDataFrame(as_rows(rows), SCHEMA).repartition(3))
    want, digest = plain_codes(rows)
    assert got.columns == ["vec_id", "code", "error", "label_error"]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    if want:
        assert books.digest() == digest


def test_active_entries_give_what_a_whole_scan_gives():
    rnd = np.random.default_rng(3)
    vectors = rnd.integers(-3, 4, (400, 16))
    books = codes.Codebooks(np.ascontiguousarray(vectors[:16].reshape(16, 8, 2).transpose(1, 0, 2)), np.ones((8, 16), bool))
    code, distance = codes.assign(vectors, books)
    quiet = 0
    for _ in range(5):
        books = books.updated(codes._totals(vectors, code, 16))
        quiet += (~books.moved).sum()
        code, distance = codes.assign(vectors, books, code, distance)
        whole = codes.assign(vectors, books)
        assert (code == whole[0]).all() and (distance == whole[1]).all()
    assert quiet  # some entries did not move, so the shorter comparison was taken


def test_vectors_of_other_lengths_and_too_large_ones_get_no_code(spark):
    rows = [(3, [1.0] * 8, 0), (1, [1.0] * 16, 0), (0, [1.0] * 7, 0), (2, [0.5] * 16, 0), (4, [1e30] * 16, 0)]
    got, _ = codes.vector_codes(spark.createDataFrame(as_rows(rows), SCHEMA))
    assert sorted(r["vec_id"] for r in got.collect()) == [1, 2]


def plain_negatives(rows, is_anchor, scale=256):
    able = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab, n) for n, (i, v, lab) in enumerate(rows)
            if lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    last = 1 << 63
    for i, v, lab, n in able:
        if i is None or not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), last if j is None else j, m, other) for j, w, other, m in able if m != n and len(w) == len(v))
        for down, j, m, other in [s for s in scored if s[3] == lab][:5]:
            fit = [s for s in scored if s[3] != lab and 80 * -down <= 100 * -s[0] <= 100 * -down][:5]
            out += [(i, None if j == last else j, k + 1, None if s[1] == last else s[1], -down, -s[0]) for k, s in enumerate(fit)]
    return out


def same_rows(got, want):
    return sorted(map(str, map(tuple, got))) == sorted(map(str, want))


@pytest.mark.parametrize("small", [True, False])
def test_hard_negatives_equal_all_pairs(spark, monkeypatch, small):
    """Ties, copies, repeated and missing ids, zero vectors and two lengths; one label has two thirds of all rows."""
    if small:
        for name, value in {"BLOCK": 40, "GROUP": 12, "MEMBERS": 4, "STEP": 8, "FLOOR_SAMPLE": 30}.items():
            monkeypatch.setattr(hn, name, value)
    rows = odd_vectors(240, 6, seed=4) + [(k, [0.25 * (k % 5), 0.5, -0.25], k % 3) for k in range(40)]
    df = spark.createDataFrame(as_rows(rows), SCHEMA).repartition(5)
    got = hn.hard_negatives(df, F.col("id") % 10 == 0)
    want = plain_negatives(rows, lambda i: i % 10 == 0)
    assert want and same_rows(got.collect(), want)


def test_no_rows_and_no_anchors_give_nothing(spark):
    df = spark.createDataFrame(as_rows(odd_vectors(20, 4, seed=1)), SCHEMA)
    for rows, anchor in ((df.limit(0), F.lit(True)), (df, F.lit(False))):
        found = hn.hard_negatives(rows, anchor)
        assert found.count() == 0 and dict(found.dtypes)["rank"] == "int"


def test_a_large_cluster_is_cut_and_small_ones_share_a_group(spark):
    anchors = spark.createDataFrame([(n, 0 if n < 70 else n % 7) for n in range(100)], "row long, cluster long")
    got = hn._grouped(anchors, 20, 4).groupBy("group").agg(F.count("*").alias("n"), F.collect_set("cluster").alias("c")).collect()
    assert sum(r["n"] for r in got) == 100 and max(r["n"] for r in got) <= 40
    assert sum(0 in r["c"] for r in got) >= 4
    assert sorted(r["group"] for r in got) == list(range(max(r["group"] for r in got) + 1))


def test_a_walk_ends_before_the_list_does():
    """Members of a narrow cluster see few of the candidates, and lose none that counts."""
    rnd = np.random.default_rng(0)
    centre = rnd.normal(size=24)
    members = np.floor(256 * (centre + 0.05 * rnd.normal(size=(10, 24)))).astype(np.int64)
    candidates = np.floor(256 * np.concatenate([centre + 0.1 * rnd.normal(size=(50, 24)), rnd.normal(size=(5000, 24))])).astype(np.int64)
    best = [hn.Found.empty() for _ in members]

    def take(m, places, scores):
        best[m] = best[m].with_more(scores, places, places, 5)

    formed = hn.walk(members, candidates, lambda m: best[m].floor(5, -np.inf), take)
    assert formed < 0.4 * len(members) * len(candidates)
    exact = members @ candidates.T
    for m in range(len(members)):
        order = sorted(range(len(candidates)), key=lambda c: (-exact[m, c], c))[:5]
        assert best[m].id.tolist() == order


def test_bounds_hold_for_every_member():
    rnd = np.random.default_rng(1)
    for spread in (0.01, 0.3, 3.0):
        members = np.floor(256 * (rnd.normal(size=12) + spread * rnd.normal(size=(20, 12)))).astype(np.int64)
        candidates = np.floor(256 * rnd.normal(size=(300, 12))).astype(np.int64)
        order, bound = hn.shared_list(members, candidates)
        assert (np.diff(bound) <= 0).all()
        length = np.linalg.norm(members.astype(float), axis=1)
        assert ((members @ candidates[order].T) <= length[:, None] * bound[None] + hn.SLACK).all()


def test_products_are_exact_beyond_doubles():
    a = np.array([[(1 << 26) - 1] * 3, [3, -5, 7]], dtype=np.int64)
    assert hn.products(a, a).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, s)) for s in a] for r in a]


def test_floor_sample_of_one_label_bounds_only_that_label(spark):
    """A label that is too rare in the sample has no floor, and still all its positives."""
    rows = [(k, [0.8, k / 1000], 0) for k in range(0, 150)] + [(1000, [1.0, 0.0], 1), (1007, [0.9, 0.1], 1)]
    got = hn.hard_negatives(spark.createDataFrame(as_rows(rows), SCHEMA), F.col("id") == 1000).collect()
    assert same_rows(got, plain_negatives(rows, lambda i: i == 1000)) and len(got) == 5


@pytest.mark.parametrize("name", ["op11_active_lloyd", "op12_hard_negatives"])
def test_queries_give_a_row_shape_on_small_tables(spark, name):
    rows = registry.queries()[name](spark, SMALL)
    assert rows.count() > 0 and len(set(rows.columns)) == len(rows.columns)
