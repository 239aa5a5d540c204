"""Near-duplicates, vectors, components, language model, quality and rollups against plain Python."""

import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstline.llm import brown, near_dup, quality, rollups, shingles, vectors
from burstline.llm.common import new_path
from burstline.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def groups(nodes, links):
    """Smallest node reachable, by plain search."""
    near = {n: set() for n in nodes}
    for a, b in links:
        near[a].add(b)
        near[b].add(a)
    out = {}
    for start in sorted(nodes):
        stack = [start]
        while stack:
            n = stack.pop()
            if n not in out:
                out[n] = start
                stack += near[n]
    return out


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(5, 3), (3, 5), (None, 2)], [(k, k + 1) for k in range(60)], [(0, k) for k in range(1, 200)],
    [tuple(random.Random(k).sample(range(150), 2)) for k in range(110)],
])
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if None not in (a, b) and a != b]
    assert got == groups({n for link in real for n in link}, real)


def shingle(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_corpus():
    rnd = random.Random(8)
    say = lambda n: [rnd.choice("abcdefghijklmnop") + rnd.choice("xyz") for _ in range(n)]
    texts = [None, "", " \t", "one", "One", "two words", "two words", "x"]
    for size, copies in ((40, 40), (200, 60), (900, 5), (6, 4)):
        base = say(size)
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randint(0, max(1, size // 25))):
                own[rnd.randrange(size)] = "changed" + rnd.choice("abcdef")
            texts.append(" ".join(own))
    texts += [" ".join(say(50)) for _ in range(30)] + [" ".join(base)] * 20
    rnd.shuffle(texts)
    return [(1000 - 3 * k, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("block", [near_dup.BLOCK, 5])
def test_near_duplicates_as_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rows = near_corpus()
    sets = {i: shingle(t) for i, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = groups(sets, links)
    got = near_dup.near_duplicates(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, print string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert len(got) == len(rows)


def test_near_duplicates_of_repeated_and_nameless_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(4, text), (4, text), (None, text), (4, "other words here"), (None, None), (None, "alone"), (2, text + " more")]
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in got) == sorted([
        ("4", 26, "2", False), ("4", 26, "2", False), ("None", 26, "2", False), ("4", 1, "4", True), ("None", 0, "None", True), ("None", 1, "None", True), ("2", 27, "2", True),
    ])
    assert near_dup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_estimates_are_close():
    rnd = np.random.default_rng(1)
    errors, fine = [], []
    for share in (0.3, 0.6, 0.85, 0.95):
        for size in (30, 400, 5000):
            for _ in range(10):
                common = rnd.integers(0, 1 << 63, int(2 * size * share / (1 + share)), dtype=np.uint64) * np.uint64(2)
                rest = size - len(common)
                a, b = (np.unique(np.concatenate([common, rnd.integers(0, 1 << 63, rest, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])) for _ in "ab")
                true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
                n = np.array([len(a)]), np.array([len(b)])
                errors.append(float(shingles.estimate(shingles.registers(a)[None], shingles.registers(b)[None], *n)[0]) - true)
                fine.append(float(shingles.fine_estimate(shingles.fine_registers(a)[None], shingles.fine_registers(b)[None])[0, 0]) - true)
    assert np.std(errors) < 0.07 and abs(np.mean(errors)) < 0.02 and np.std(fine) < 0.025 and abs(np.mean(fine)) < 0.01


def vector_rows():
    rnd = np.random.default_rng(3)
    rows = []
    for label in (0, 1, None):
        for _ in range(6):
            center = rnd.normal(size=8)
            for _ in range(rnd.integers(1, 25)):
                rows.append(((center + rnd.normal(size=8) * 0.13).tolist(), label))
    rows += [(rows[0][0], 0)] * 3 + [([2 * x for x in rows[0][0]], 0), ([1e-200] * 8, 1), ([1e200] * 8, 1), ([0.0] * 8, 1), (None, 1), ([], 1), ([float("nan")] * 8, 1), ([None] + [1.0] * 7, 1)]
    rows += [([float("inf")] + [1.0] * 7, 1), ([1.0, 2.0], 1), ([2.0, 4.0], 1), ([1.0], 0), ([3.0], 0)]
    return [(500 - k, v, label) for k, (v, label) in enumerate(rows)]


@pytest.mark.parametrize("block", [vectors.BLOCK, 7])
def test_vectors_as_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = vector_rows()

    def cosine(a, b):
        a, b = (np.array(x) / np.abs(x).max() for x in (a, b))
        return a @ b / np.linalg.norm(a) / np.linalg.norm(b)

    able = [(i, v, label) for i, v, label in rows if label is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    links = [(a[0], b[0]) for a, b in itertools.combinations(able, 2) if a[2] == b[2] and len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.93]
    want, count = groups([r[0] for r in rows], links), Counter(x for link in links for x in link)
    got = vectors.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), recall=1.0)
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in got.collect()} == {i: (count[i], want[i], want[i] == i) for i, _, _ in rows}


def test_vectors_without_any_to_compare(spark):
    form = "vec_id long, embedding array<float>, label int"
    assert vectors.near_vectors(spark.createDataFrame([], form)).count() == 0
    got = vectors.near_vectors(spark.createDataFrame([(3, None, 1), (None, [1.0], None)], form)).collect()
    assert sorted((str(r["vec_id"]), r["n_links"], r["kept"]) for r in got) == [("3", 0, True), ("None", 0, True)]


def test_visits_are_in_order_of_distance():
    rnd = np.random.default_rng(0)
    index = vectors.MultiIndex(rnd.normal(size=(300, 10)), 6)
    points = rnd.normal(size=(20, 10))
    first, second = (((p[:, None] - b[None]) ** 2).sum(-1) for p, b in zip((points[:, :5], points[:, 5:]), index.books))
    total = (first[:, :, None] + second[:, None, :]).reshape(20, -1)
    for most in (1, 4, 17, index.cells):
        assert (index.visits(points, most) == np.argsort(total, axis=1, kind="stable")[:, :most]).all()


@pytest.mark.parametrize("codes", [56, vectors.MOST_CODES])
def test_cells_hold_links_of_lone_pairs_beside_a_dense_group(spark, monkeypatch, codes):
    """Per vector, at 0.93 and with large codebooks: the dense group has nearly all links, and each lone pair just one."""
    rnd, dim, n, dense, pairs = np.random.default_rng(4), 64, 12_000, 600, 150
    x = rnd.normal(size=(n, dim))
    x[:dense] = x[0] + 0.1 * rnd.normal(size=(dense, dim))
    first, second = slice(dense, dense + pairs), slice(dense + pairs, dense + 2 * pairs)
    x[second] = x[first] + 0.35 * rnd.normal(size=(pairs, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    monkeypatch.setattr(vectors, "CELL_ROWS", n / codes**2)
    nodes = spark.createDataFrame([(k, 7, v.tolist()) for k, v in enumerate(x)], "node long, label long, vector array<double>")
    index, most = vectors.fitted_index(nodes, dim, 0.93, vectors.RECALL)
    assert [len(b) for b in index.value.books] == [codes, codes]
    own = np.concatenate([index.value.visits(x[k : k + 500], 1)[:, 0] for k in range(0, n, 500)])
    recall = {}
    for k in range(dense + 2 * pairs):
        linked = np.flatnonzero(x @ x[k] >= 0.93)
        linked = linked[linked != k]
        if len(linked):
            recall[k] = np.isin(own[linked], index.value.visits(x[k : k + 1], most)[0]).mean()
    lone = [r for k, r in recall.items() if k >= dense]
    assert len(lone) > 200 and np.mean(lone) >= 0.99 and np.mean(list(recall.values())) >= 0.99


def test_links_found_on_the_given_vectors(spark):
    """The share of true links found, per vector, on the table the other tests do not reach."""
    path = "/root/testdata/sf0.01/embeddings.parquet"
    rows = spark.read.parquet(path).collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r["label"] for r in rows])
    near = (x @ x.T >= 0.5) & (label[:, None] == label[None])
    want = {r["vec_id"]: int(n) - 1 for r, n in zip(rows, near.sum(1))}
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(spark.read.parquet(path), least=0.5, recall=0.95).collect()}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) >= 0.9 * sum(want.values())


def brown_docs():
    rnd = random.Random(6)
    say = lambda letters, n: " ".join(rnd.choice(letters) + rnd.choice("aeiou") * rnd.randint(1, 3) for _ in range(n))
    rows = [(k, say("bcd" if k % 2 else "xyz", 60)) for k in range(80)]
    return rows + [(100, None), (101, ""), (102, " \n"), (103, "Unseen-Words " + "w" * 300), (103, "Unseen-Words " + "w" * 300), (None, "baa CAA"), (104, say("bx", 9000))]


@pytest.mark.parametrize("known", [brown.KNOWN, 5])
def test_scores_as_by_hand(spark, monkeypatch, known):
    monkeypatch.setattr(brown, "KNOWN", known)
    rows = brown_docs()
    tokens = [WORDS.findall((t or "").translate(LOWER)) + [None] for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    count = Counter(t for own, out in zip(tokens, held) if not out for t in own)
    total, kinds = sum(count.values()), len(count)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = brown.scored(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).collect()
    base = lambda own: sum(np.log10((count[t] + 1) / (total + kinds + 1)) for t in own)
    want = sorted((str(i), h, len(own), sum(count[t] > 0 for t in own), round(base(own), 6)) for (i, _), own, h in zip(rows, tokens, held))
    assert sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {total}
    out = [r for r in got if r["held_out"] and r["n_tokens"] > 20]
    assert out and sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_scores_do_not_depend_on_what_is_broadcast(spark, monkeypatch):
    docs = spark.createDataFrame(brown_docs(), "doc_id long, text string").where("doc_id < 100")
    scores = []
    for known in (brown.KNOWN, 600):
        monkeypatch.setattr(brown, "KNOWN", known)
        monkeypatch.setattr(brown, "WORD_UNITS", 5)
        scores.append({r["doc_id"]: round(r["score"], 6) for r in brown.scored(docs, F.col("doc_id") % 3 == 0).collect()})
    assert scores[0] == scores[1]


def test_scores_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row, = brown.scored(docs, F.lit(True)).collect()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)
    assert brown.scored(docs.limit(0), F.lit(False)).count() == 0


def test_probabilities_sum_to_one_at_most():
    """Over all words, seen and one unseen per class, after any word."""
    pairs = np.array([[0, 5, 3, 0], [4, 9, 1, 1], [2, 1, 8, 0], [2, 0, 0, 1]], dtype=float)
    label = brown.exchange_classes(pairs, 3)
    one = np.eye(label.max() + 1)[label]
    moves = one.T @ pairs @ one
    n = moves.sum(0)
    base = (n + 1) / (n.sum() + len(n))
    given = (moves + brown.PRIOR * base) / (moves.sum(1, keepdims=True) + brown.PRIOR)
    assert np.allclose(given.sum(1), 1) and label[0] == 0 and (label[1:] > 0).all()


def test_exchange_finds_the_classes():
    """Two kinds of words that follow their own kind: the likelihood is best with the kinds apart."""
    rnd = np.random.default_rng(5)
    kind = rnd.permutation(np.repeat([0, 1], 10))
    pairs = np.zeros((21, 21))
    pairs[1:, 1:] = np.where(kind[:, None] == kind[None], 50, 1) + rnd.integers(0, 5, (20, 20))
    pairs[0, 1:] = pairs[1:, 0] = 2
    label = brown.exchange_classes(pairs, 3)
    assert len({(k, c) for k, c in zip(kind, label[1:])}) == 2


def test_quality_gradients():
    rnd = np.random.default_rng(2)
    counts, y = np.array([1, 3, 2]), np.array([1.0, 0.0, 1.0])
    x = rnd.normal(size=(6, quality.WIDTH))
    w = {k: rnd.normal(size=s) * 0.3 for k, s in {"encode": (quality.WIDTH, 4), "encode_bias": (4,), "value": (4, 3), "gate": (4, 3), "attend": (3,), "out": (4,), "bias": ()}.items()}

    def loss(weights):
        p = quality._sigmoid(quality._forward(weights, x, counts)["logit"])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for name, g in quality._gradients(w, x, counts, y).items():
        for at in list(np.ndindex(*w[name].shape))[:7]:
            step = {k: np.array(v) for k, v in w.items()}
            step[name][at] += 1e-6
            assert (loss(step) - loss(w)) / 1e-6 == pytest.approx(g[at], rel=1e-3, abs=1e-5), name


def test_quality_on_held_out_documents(spark):
    where = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet")
    model = quality.trained(docs, labels)
    got = quality.scored(docs, model).join(labels, "doc_id").where(quality.held_out()).select("score", "quality").collect()
    assert len(got) > 50 and np.mean([(r["score"] >= 0.7) == (r["quality"] == 1) for r in got]) > 0.95
    # Labels of held-out rows never matter.
    turned = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = quality.trained(docs, turned)
    assert all((model.weights[k] == other.weights[k]).all() for k in model.weights)


def test_quality_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "", 5.0), (2, "", 5.0), (None, "a word", 5.0), (3, "long " * 60_000, 5.0), (4, "x" * 3000, 5.0)], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (2, 1), (None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    got = quality.scored(docs, quality.trained(docs, labels)).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert {r["score"] for r in quality.scored(docs, quality.trained(docs.limit(0), labels)).collect()} == {0.5}
    assert quality.scored(docs.limit(0), quality.trained(docs, labels)).count() == 0


def test_rollup_as_by_hand(spark):
    form = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long, extra string"
    batches = {
        "b1": [("insert", "s", "en", "v1", 10, None, ""), ("insert", "s", "en", "v1", 5, None, ""), ("insert", None, None, "v1", None, None, ""), ("insert", "t", "de", "v2", 7, None, "")],
        "b2": [("revise", "s", "en", "v1", 8, 10, ""), ("delete", "t", "de", "v2", 7, None, "")],
        "b3": [],
    }
    state = rollups.Rollup(spark, new_path(spark, "rollup-test"))
    assert state.totals().count() == 0
    changed = [state.commit(name, spark.createDataFrame(batches[name], form)) for name in ("b1", "b2", "b1", "b3", "b2")]
    assert changed == [True, True, False, True, False]
    assert sorted(map(str, (tuple(r) for r in state.totals().collect()))) == sorted(map(str, [("s", "en", "v1", 2, 13), (None, None, "v1", 1, 0)]))
    with pytest.raises(Exception, match="unknown change"):
        state.commit("bad", spark.createDataFrame([("rename", "s", "en", "v1", 1, 1, "")], form))
    assert state.totals().count() == 2


def family(count, common, own, seed=1):
    """Texts of ``common`` words that all share and ``own`` words of each."""
    return [(k, " ".join([*(f"c{j}" for j in range(common)), *(f"o{k}.{j}" for j in range(own))])) for k in range(count)]


def test_a_family_just_below_the_threshold_costs_few_rows(spark, monkeypatch):
    """120 texts of mutual similarity 0.84: all are open to the estimate, none is linked, and no table of pairs is formed."""
    rows = []
    kept_written = near_dup.written

    def counting(df, name):
        out = kept_written(df, name)
        rows.append((name, out.count()))
        return out

    monkeypatch.setattr(near_dup, "written", counting)
    docs = family(120, 155, 14) + [(1000, "zz " * 40), (1001, "zz " * 41)]
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == {1001}
    made = dict(rows)
    assert made["open-classes"] <= 28 * 120 and made["further-links"] == 0


def test_links_in_a_block_equal_all_pairs(spark):
    """Chains of texts, each linked with the next one only, in one bucket with a family above the threshold."""
    rnd = random.Random(2)
    docs = family(60, 200, 9) + [(100 + k, t) for k, t in family(50, 160, 16)]
    words = [f"w{j}" for j in range(400)]
    docs += [(200 + k, " ".join(words[8 * k : 8 * k + 170])) for k in range(25)]
    rnd.shuffle(docs)
    sets = {i: {tuple(t.split()[j : j + 5]) for j in range(len(t.split()) - 4)} for i, t in docs}
    top = {i: i for i in sets}

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    got = near_dup.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), percent=85).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: root(i) for i in sets}


def test_common_members_are_counted_in_parts(monkeypatch):
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 300, rnd.integers(0, 120)).astype(np.uint64)) for _ in range(30)]
    for columns in (7, 4096):
        monkeypatch.setattr(near_dup, "COLUMNS", columns)
        got = near_dup.common_counts(sets[:12], sets[12:])
        assert got.tolist() == [[len(np.intersect1d(x, y)) for y in sets[12:]] for x in sets[:12]]
    assert near_dup.common_counts([], sets).shape == (0, 30) and not near_dup.common_counts([sets[0][:0]], [sets[0][:0]]).any()


def test_rows_equal_in_id_and_text_leave_the_same_one(spark):
    rows = [(1, "a b c d e f", "en", 5), (1, "a b c d e f", "de", 6), (1, "a b c d e f", None, None), (2, "x y z", "fr", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    left = {tuple(map(tuple, near_dup.first_of_each(docs.repartition(k).orderBy(F.rand(k))).orderBy("doc_id").collect())) for k in (1, 2, 3)}
    assert len(left) == 1 and [r[0] for r in left.pop()] == [1, 2]


CHANGES = "op string, source string, lang string, tokenizer string, n_tokens long, old_tokens long"


def inserts(spark, *counts, source="s"):
    return spark.createDataFrame([("insert", source, "en", "t", n, None) for n in counts], CHANGES)


def sums(rollup):
    return sorted((r["source"], r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect())


@pytest.mark.parametrize("at", ["totals", "before", "after"])
def test_a_commit_that_breaks_off_can_be_repeated(spark, tmp_path, monkeypatch, at):
    """Broken while the totals are written, before they are published, and after that but before the batch has its mark."""
    from burstline.llm.rollups import Rollup
    from burstline.sinks.versions import Versions

    rollup = Rollup(spark, str(tmp_path))
    rollup.commit("one", inserts(spark, 5, 6))

    def broken(*_):
        raise OSError("lost")

    if at == "totals":
        (tmp_path / "totals-x" / "_temporary").mkdir(parents=True)
        monkeypatch.setattr(Versions, "fresh", broken)
    elif at == "before":
        monkeypatch.setattr(Versions, "publish", broken)
    else:
        own = Versions.mark
        monkeypatch.setattr(Versions, "mark", lambda v, name: own(v, name) if v.marked(name) or name == rollup.versions.state(1).content["batch"] else broken())
    with pytest.raises(OSError):
        rollup.commit("two", inserts(spark, 7))
    monkeypatch.undo()
    again = Rollup(spark, str(tmp_path))
    assert again.commit("two", inserts(spark, 7)) is (at != "after")
    assert sums(again) == [("s", 3, 18)] and not again.commit("two", inserts(spark, 7)) and not again.commit("one", inserts(spark, 5, 6))
    assert again.commit("three", inserts(spark, 1)) and sums(again) == [("s", 4, 19)]


def test_commits_at_once_lose_nothing(spark, tmp_path):
    import threading

    from burstline.llm.rollups import Rollup

    done = []
    threads = [threading.Thread(target=lambda k=k: done.append(Rollup(spark, str(tmp_path)).commit(f"b{k % 3}", inserts(spark, 10 ** (k % 3))))) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(done) == [False, True, True, True] and sums(Rollup(spark, str(tmp_path))) == [("s", 3, 111)]


def likelihood(tokens, label, classes):
    table = np.zeros((classes, classes))
    for row in tokens:
        for x, y in zip(row, row[1:]):
            table[label[x], label[y]] += 1
    f = lambda x: (x * np.log(np.maximum(x, 1e-300))).sum()
    return f(table) - f(table.sum(0)) - f(table.sum(1))


def test_rounds_move_each_word_as_by_hand(spark, monkeypatch):
    """Every word of a small corpus goes where the likelihood of all class bigrams, counted anew for each class, is largest."""
    rnd, docs = random.Random(8), []
    for k in range(60):
        row = []
        for j in range(25):
            kind = "abc" if (j + k) % 2 else "xyz"
            word = rnd.choice(kind) + rnd.choice("lmnop")
            row.append(word if not row or word != row[-1] else word + "q")
        docs.append((k, " ".join(row)))
    tokens = [[" ", *t.split(), " "] for _, t in docs]
    words = [" ", *sorted({w for row in tokens for w in row} - {" "})]
    numbers = brown.Numbers([w.encode() for w in words], [])
    label = np.array([0, *(1 + k % 3 for k in range(len(words)))], dtype=np.int64)  # and that of any other word
    number = {w: k for k, w in enumerate(words)}
    coded = [[number[w] for w in row] for row in tokens]
    want, first = list(label), 4
    for word in range(first, len(words)):
        by_class = []
        for c in range(1, 4):
            tried = list(label)
            tried[word] = c
            by_class.append(likelihood(coded, tried, 4))
        best = max(by_class)
        want[word] = label[word] if best <= by_class[label[word] - 1] + 1e-6 else 1 + by_class.index(best)
    train = spark.createDataFrame(docs, "id long, _text string").select("_text").repartition(3)
    train = train.mapInArrow(brown._coded(spark.sparkContext.broadcast(numbers)), "ids binary")
    monkeypatch.setattr(brown, "CODES", 50)
    got, table = brown.exchanged(train, label, first, len(words), 1)
    assert got.tolist() == [int(x) for x in want] and (got != label).any()
    assert table.sum() == sum(len(row) - 1 for row in tokens)
    more, _ = brown.exchanged(train, label, first, len(words), 5)
    assert likelihood(coded, more, 4) >= likelihood(coded, got, 4) > likelihood(coded, label, 4)
    assert brown.exchanged(train, label, first, first, 3)[0].tolist() == label.tolist()


@pytest.mark.parametrize("kinds", [900, 2700])
def test_words_that_are_exchanged_grow_with_the_corpus(spark, monkeypatch, kinds):
    asked = []
    own = brown.exchanged
    monkeypatch.setattr(brown, "exchanged", lambda coded, label, first, last, rounds: asked.append(last - first) or own(coded, label, first, last, rounds))
    docs = [(k, " ".join(f"w{(k * 37 + j) % kinds}" for j in range(100))) for k in range(kinds // 10)]
    assert brown.scored(spark.createDataFrame(docs, "doc_id long, text string"), F.lit(False)).count() == len(docs)
    assert asked == [kinds - brown.WORD_UNITS]
