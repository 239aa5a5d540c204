"""Quality scores and language posteriors, recomputed step by step in plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from burstline.llm import langid, quality

BLANKS = b"\t\n\x0b\x0c\r "


def plain_words(data):
    """Words with the place of their first byte."""
    out, start = [], None
    for k, byte in enumerate(data):
        if byte in BLANKS:
            if start is not None:
                out.append((start, bytes(data[start:k])))
            start = None
        elif start is None:
            start = k
    return out


def plain_passages(text):
    data = text + b"\n"
    words, rows = plain_words(data), []
    for low in range(0, len(data), quality.PASSAGE):
        part = data[low : low + quality.PASSAGE]
        n = len(part)
        kinds = [0] * quality.N_KINDS
        for byte in part:
            kinds[quality.KINDS[byte]] += 1
        own = [w for at, w in words if low <= at < low + quality.PASSAGE]
        total = max(len(own), 1)
        kind = lambda byte: quality.KINDS[byte]
        shape = [
            len(own) / n * 8, math.log1p(sum(map(len, own)) / total), sum(len(w) <= 3 for w in own) / total, sum(len(w) >= 10 for w in own) / total,
            sum(a == b for a, b in zip(own, own[1:])) / total, (len(own) - len(set(own))) / total, sum(kind(w[-1]) == 10 for w in own) / total,
            sum(len(w) == 1 and kind(w[0]) == 10 for w in own) / total, sum(kind(w[-1]) in (6, 7) for w in own) / total,
        ]
        pairs = [0] * quality.PAIRS
        for k in range(low, min(low + quality.PASSAGE, len(data) - 1)):
            pairs[((data[k] * 31 + data[k + 1]) * 2654435761 >> 16) % quality.PAIRS] += 1
        rows.append([math.sqrt(x / n) for x in kinds] + shape + [math.sqrt(x / n) for x in pairs] + [n / (n + quality.SHORT)])
    return rows


def plain_score(model, rows):
    """Gated attention, passage by passage."""
    w, hidden, weights = model.weights, [], []
    for row in rows:
        x = [(v - m) / s * row[-1] for v, m, s in zip(row[:-1], model.mean, model.scale)]
        h = [math.tanh(sum(a * b for a, b in zip(x, column)) + bias) for column, bias in zip(w["encode"].T, w["encode_bias"])]
        t = [math.tanh(sum(a * b for a, b in zip(h, column))) for column in w["value"].T]
        g = [1 / (1 + math.exp(-sum(a * b for a, b in zip(h, column)))) for column in w["gate"].T]
        hidden.append(h)
        weights.append(sum(a * b * c for a, b, c in zip(t, g, w["attend"])))
    top = max(weights)
    share = [math.exp(e - top) for e in weights]
    z = [sum(a * h[k] for a, h in zip(share, hidden)) / sum(share) for k in range(len(hidden[0]))]
    return 1 / (1 + math.exp(-(sum(a * b for a, b in zip(z, w["out"])) + float(w["bias"]))))


def sample_texts():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeäß#1.,Z漢") for _ in range(rnd.randint(1, 13)))
    texts = [" ".join(word() for _ in range(n)) for n in (0, 1, 5, 90, 400)] + ["the the the\tthe  \n\n.", " ", "x" * 1500, "a " * 700, "#### $$ %% !"]
    return [t.encode() for t in texts]


def test_passages_as_by_hand():
    texts = sample_texts()
    x, counts = quality.passages(texts)
    want = [plain_passages(t) for t in texts]
    assert counts.tolist() == [len(rows) for rows in want]
    assert np.allclose(x, np.array([row for rows in want for row in rows]), atol=1e-5)


def test_a_passage_does_not_depend_on_other_texts():
    texts = sample_texts()
    alone = np.concatenate([quality.passages([t])[0] for t in texts])
    assert np.array_equal(quality.passages(texts)[0], alone)


def test_scores_as_by_hand(spark):
    rnd = random.Random(9)
    good = [" ".join(rnd.choice(["house", "river", "stone", "walked", "slowly"]) for _ in range(200)) + "." for _ in range(40)]
    bad = [" ".join(rnd.choice(["$$$", "BUY", "#1", "!!"]) for _ in range(200)) for _ in range(40)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 40)) for k in range(80)], "doc_id long, quality int")
    model = quality.trained(docs, labels)
    asked = [*sample_texts(), good[0].encode(), bad[0].encode(), (good[1] + bad[1]).encode()]
    rows = spark.createDataFrame([(k, t.decode()) for k, t in enumerate(asked)], "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["score"] for r in quality.scored(rows, model).collect()}
    for k, text in enumerate(asked):
        assert got[k] == pytest.approx(plain_score(model, plain_passages(text)), abs=2e-4)


def test_language_posteriors_as_by_hand(spark):
    """Sums of hosts, domains, declarations and suffixes without the row itself, added up by hand from the text posteriors."""
    say = {"en": "the house of the man that was there and with them ", "de": "der hund und die katze sind nicht im haus und auch ", "fr": "le chat de la maison est dans le jardin avec les "}
    rnd = random.Random(3)
    mixed = lambda lang: " ".join(rnd.sample(say[lang].split(), 6))
    train = spark.createDataFrame([(k, mixed(lang) + " " + say[lang], lang) for k, lang in enumerate(list(say) * 30)], "doc_id long, text string, lang string")
    model = langid.trained(train)
    hosts = ["a.ex.de", "b.ex.de", "x.org", "", None, "c.fr"]
    rows = [(k, mixed(rnd.choice(list(say))) if k % 7 else "12 34 !", rnd.choice(["en", "de", "", None]), rnd.choice(hosts)) for k in range(60)]
    rows += [rows[1], (60, None, "en", "x.org"), (61, "", None, None)]
    df = spark.createDataFrame(rows, "id long, text string, said string, host string")
    got = sorted(map(str, ((r["id"], r["language"], round(r["confidence"], 6)) for r in langid.identify(df.repartition(4), model, F.col("text"), F.col("said"), F.col("host")).collect())))

    names, count = model.languages, len(model.languages)
    clean = [((h or "").lower(), (s or "").lower()) for _, _, s, h in rows]
    parts = [(h, ".".join(h.split(".")[-2:]), h.split(".")[-1], s) for h, s in clean]
    texts = []
    for _, text, _, _ in rows:
        evidence = list(model.evidence(text))
        logs, letters = evidence[:count], evidence[count] > 0
        top = max(logs)
        share = [math.exp(x - top) for x in logs]
        texts.append((logs, [x / sum(share) for x in share], letters))

    def added(at, value):
        """Sums of the posteriors of all rows with letters that have the value."""
        out = [0.0] * count
        for part, (_, own, letters) in zip(parts, texts):
            if part[at] == value and letters:
                out = [a + b for a, b in zip(out, own)]
        return out

    total = [sum(own[k] for _, own, letters in texts if letters) for k in range(count)]
    whole = [(x + 1) / sum(t + 1 for t in total) for x in total]
    with_letters = [part for part, (_, _, letters) in zip(parts, texts) if letters]
    kinds = {at: len({part[at] for part in with_letters}) for at in (2, 3)}
    want = []
    for (i, *_), part, (logs, own, letters) in zip(rows, parts, texts):
        mine = own if letters else [0.0] * count
        scores = list(logs)
        if part[0]:
            above = [max(x - m, 0) + langid.STRENGTH * w for x, m, w in zip(added(1, part[1]), mine, whole)]
            above = [x / sum(above) for x in above]
            prior = [max(x - m, 0) + langid.STRENGTH * a for x, m, a in zip(added(0, part[0]), mine, above)]
            prior = [x / sum(prior) for x in prior]
            scores = [s + math.log((x + 1) / (t + kinds[2] + 1)) for s, x, t in zip(scores, added(2, part[2]), total)]
        else:
            prior = whole
        scores = [s + math.log(p) + math.log((x + 1) / (t + kinds[3] + 1)) for s, p, x, t in zip(scores, prior, added(3, part[3]), total)]
        top = max(scores)
        post = [math.exp(s - top) for s in scores]
        post = [p / sum(post) for p in post]
        best = max(range(count), key=lambda k: post[k])  # noqa: B023
        want.append(str((i, names[best], round(post[best], 6))))
    assert got == sorted(want)
