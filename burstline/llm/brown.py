"""Language-model scores by a class-based bigram model whose classes come from exchange clustering.

1. Tokens of the training documents are counted: part counts in the tasks, one sum per word.
2. The most frequent words are units of their own; every other word, seen or not, belongs to the unit of its ending.
   Unit pairs are counted over all training documents. The table of these counts has at most UNITS^2 entries, so the driver holds it.
   Exchange clustering moves units between classes, one at a time, while the likelihood of the class bigrams grows.
3. Then every known word that was seen often enough is exchanged by itself, in rounds over the whole training text: tasks count
   the classes before and after each word and the table of class bigrams, and each word goes to the class where the likelihood is largest
   while the others stay (as in published distributed word clustering). So the units grow with the vocabulary, up to the words whose
   classes fit a broadcast; only words that are rarer still, and unseen ones, keep the class of their ending.
4. log10 P(text) = sum over tokens of log10 P(class | class before) + log10 P(word | class), the text's end being a token and
   also the context of the first word. P(class | before) is smoothed towards P(class), P(word | class) is
   (c + 1) / (N_class + V_class + 1): each class keeps the mass of one unseen word.

Counts of frequent words reach the scoring tasks by broadcast (a bounded number of words of bounded length). The
rest are joined: a row per document and rare word meets the word's count, and the documents' sums
come back by row number. So no frequent word is ever a join key.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import blank_words, pieces_of, table, written

END = b" "  # no word holds a blank
KNOWN = 200_000  # words whose counts and classes are broadcast
LONGEST = 64  # bytes of a word that may be among them
WORD_UNITS, ENDING_UNITS = 512, 255
ENDING = 3  # bytes
CLASSES = 48
TURNS = 8
ROUNDS = 2  # exchanges of the known words
LEAST = 5  # times a word must be seen to be exchanged by itself
CODES = 1 << 20  # neighbours of words that a task adds up at once
PRIOR = 20.0  # weight of the class distribution in P(class | class before)
TABLE = 300_000  # words that a task counts before it passes them on


def texts(column: pa.Array) -> Iterator[bytes | None]:
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def out():
        rows = pa.RecordBatch.from_arrays([pa.array([w.decode() for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])
        counts.clear()
        return rows

    for batch in pieces_of(batches):
        for text in texts(batch.column("_text")):
            counts.update(blank_words(text))
            counts[END] += 1
            if len(counts) > TABLE:
                yield out()
    yield out()


class Numbers(dict):
    """Word -> number: known words first, then endings, then 'any other'; remembers what it was asked, within a bound."""

    def __init__(self, words: list[bytes], endings: list[bytes]):
        self.base = {w: i for i, w in enumerate(words)}
        self.endings = {e: len(words) + i for i, e in enumerate(endings)}
        self.other = len(words) + len(endings)
        super().__init__(self.base)

    def __reduce__(self):
        return Numbers, (list(self.base), list(self.endings))

    def __missing__(self, word: bytes) -> int:
        if len(self) > len(self.base) + TABLE:
            self.clear()
            self.update(self.base)
        value = self[word] = self.endings.get(word[-ENDING:], self.other)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.array([self[w] for w in words], dtype=np.int64)


def _endings(known):
    """Tokens by ending, over the words that are not units of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for word, n in zip(texts(batch.column("word")), batch.column("n").to_pylist()):
                if word not in known.value:
                    counts[word[-ENDING:]] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(counts.values(), pa.int64())], names=["ending", "n"])

    return run


def _coded(numbers):
    """Each text as the numbers of its words, between two ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = numbers.value
        for batch in pieces_of(batches):
            rows = [of.of([END, *blank_words(text), END]).astype("<i4").tobytes() for text in texts(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["ids"])

    return run


def _numbers_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in pieces_of(batches, "ids"):
        for row in batch.column("ids"):
            yield np.frombuffer(row.as_py(), dtype="<i4").astype(np.int64)


def _pairs(unit_of, units: int):
    """Counts of neighbouring units; each document starts after, and stops with, its end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = unit_of.value
        total = np.zeros(units * units, dtype=np.int64)
        waiting: list[np.ndarray] = []
        size = 0
        for at in _numbers_of(batches):
            row = of[at]
            waiting.append(row[:-1] * units + row[1:])
            size += len(row)
            if size > CODES:
                total += np.bincount(np.concatenate(waiting), minlength=len(total))
                waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some // units), pa.array(some % units), pa.array(total[some])], names=["a", "b", "n"])

    return run


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def gains(table_: np.ndarray, left: np.ndarray, right: np.ndarray, own: float) -> np.ndarray:
    """What the likelihood gains by a unit in each class, given the class bigrams without it and its neighbours by class.

    ``own`` are pairs of the unit with itself. The class of the end is never an answer.
    """
    # What stands before the unit belongs to the rows of other classes, and what follows to their columns, wherever the unit goes.
    rows, cols = table_.sum(1) + left, table_.sum(0) + right
    # Cells of classes that are no neighbours do not change.
    r, b = np.flatnonzero(right), np.flatnonzero(left)
    behind, before = table_[:, r], table_[b]
    gain = (_f(behind + right[r]) - _f(behind)).sum(1) + (_f(before + left[b][:, None]) - _f(before)).sum(0)
    own_cell = np.diagonal(table_)
    gain += _f(own_cell + left + right + own) - _f(own_cell) - (_f(own_cell + right) - _f(own_cell)) - (_f(own_cell + left) - _f(own_cell))
    gain -= _f(rows + right.sum() + own) - _f(rows) + _f(cols + left.sum() + own) - _f(cols)
    gain[0] = -np.inf
    return gain


def better(gain: np.ndarray, old: int) -> int:
    """The class with the largest gain; the old one unless another is clearly better."""
    best = int(gain.argmax())
    return int(old) if gain[best] <= gain[old] + 1e-9 * abs(gain[old]) else best


def _contexts(label, classes: int, first: int, last: int):
    """Counts of class bigrams (codes below 0), and of the classes before and behind the words numbered ``first`` to ``last``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = label.value
        table_ = np.zeros(classes * classes, dtype=np.int64)
        near: list[np.ndarray] = []
        pairs: list[np.ndarray] = []
        size = 0

        def out(codes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(codes, pa.int64()), pa.array(counts, pa.int64())], names=["code", "n"])

        for at in _numbers_of(batches):
            cls = own[at]
            pairs.append(cls[:-1] * classes + cls[1:])
            size += len(at)
            if last > first:
                k = np.flatnonzero((at >= first) & (at < last))
                word = at[k] * (2 * classes)
                near += [word + cls[k - 1], word + classes + cls[k + 1]]
            if size > CODES:
                table_ += np.bincount(np.concatenate(pairs), minlength=len(table_))
                if near:
                    yield out(*np.unique(np.concatenate(near), return_counts=True))
                pairs, near, size = [], [], 0
        if pairs:
            table_ += np.bincount(np.concatenate(pairs), minlength=len(table_))
        if near:
            yield out(*np.unique(np.concatenate(near), return_counts=True))
        some = np.flatnonzero(table_)
        yield out(-1 - some, table_[some])

    return run


def _moves(table_: np.ndarray, label):
    """The class that each word goes to, from its neighbours by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = len(table_)
        for batch in batches:
            words, out = batch.column("word").to_pylist(), []
            for word, seen in zip(words, batch.column("seen").to_pylist()):
                near = np.zeros(2 * classes)
                near[[x["at"] for x in seen]] = [x["n"] for x in seen]
                left, right, old = near[:classes], near[classes:], int(label.value[word])
                without = table_.copy()
                without[old] -= right
                without[:, old] -= left
                # Pairs of words of one class, and of a word with itself, are taken out from both sides.
                out.append(better(gains(np.maximum(without, 0), left, right, 0.0), old))
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.int64()), pa.array(out, pa.int64())], names=["word", "class"])

    return run


def _table(rows: pa.Table, classes: int) -> np.ndarray:
    table_ = np.zeros(classes * classes)
    table_[-1 - rows.column("code").to_numpy()] = rows.column("n").to_numpy()
    return table_.reshape(classes, classes)


def exchanged(coded: DataFrame, label: np.ndarray, first: int, last: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Labels after so many rounds in which the words numbered ``first`` to ``last`` each move, and the class bigrams by these labels.

    ``coded`` are the training texts as numbers of words (``_coded``).
    """
    spark, classes = coded.sparkSession, int(label.max()) + 1
    form = "code long, n long"

    def counted(low: int, high: int) -> DataFrame:
        made = coded.mapInArrow(_contexts(spark.sparkContext.broadcast(label), classes, low, high), form)
        return made.groupBy("code").agg(F.sum("n").alias("n"))

    for _ in range(rounds if last > first else 0):
        near = written(counted(first, last), "word-contexts")
        table_ = _table(near.where("code < 0").toArrow(), classes)
        word = F.floor(F.col("code") / F.lit(2 * classes)).alias("word")
        seen = near.where("code >= 0").groupBy(word).agg(F.collect_list(F.struct((F.col("code") % (2 * classes)).alias("at"), "n")).alias("seen"))
        new = seen.mapInArrow(_moves(table_, spark.sparkContext.broadcast(label)), "word long, class long").toArrow()  # KNOWN rows at most
        at, to = new.column("word").to_numpy(), new.column("class").to_numpy()
        still = bool((label[at] == to).all())
        label = label.copy()
        label[at] = to
        if still:
            break
    return label, _table(counted(0, 0).toArrow(), classes)


def exchange_classes(pairs: np.ndarray, classes: int = CLASSES, turns: int = TURNS) -> np.ndarray:
    """The class of each unit. Unit 0 (the end) keeps class 0 for itself.

    ``pairs`` are counts of unit pairs. Each unit in turn, the frequent ones first, goes where the likelihood of the class
    bigrams, sum n(c,d) log n(c,d) - sum n(c) log n(c) over both sides, is largest; it stays where it is on a tie.
    """
    units = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = [int(u) for u in np.argsort(-weight, kind="stable") if u != 0]
    label = np.zeros(units, dtype=np.int64)
    count = max(1, min(classes - 1, units - 1))
    for k, u in enumerate(order):
        label[u] = 1 + k % count
    classes = count + 1
    one = np.eye(classes)[label]
    table_ = one.T @ pairs @ one
    for _ in range(turns):
        moved = False
        for u in order:
            old, own = label[u], pairs[u, u]
            right = np.bincount(label, weights=pairs[u], minlength=classes)
            left = np.bincount(label, weights=pairs[:, u], minlength=classes)
            right[old] -= own
            left[old] -= own
            # Take the unit out.
            table_[old] -= right
            table_[:, old] -= left
            table_[old, old] -= own
            best = better(gains(table_, left, right, own), old)
            label[u] = best
            moved |= best != old
            table_[best] += right
            table_[:, best] += left
            table_[best, best] += own
        if not moved:
            break
    return label


def _class_sizes(numbers, classes):
    """Tokens and distinct words of each class, over the table of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, label = numbers.value, classes.value
        for batch in batches:
            own = label[of.of(list(texts(batch.column("word"))))]
            n = np.bincount(own, weights=batch.column("n").to_numpy(), minlength=label.max() + 1).astype(np.int64)
            kinds = np.bincount(own, minlength=label.max() + 1)
            some = np.flatnonzero(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some]), pa.array(kinds[some])], names=["class", "n", "kinds"])

    return run


class Model:
    """What scoring tasks hold: numbers of words, the class of each, counts of known words, and log10 probabilities."""

    def __init__(self, numbers: Numbers, label: np.ndarray, counts: np.ndarray, moves: np.ndarray, mass: np.ndarray):
        self.numbers, self.label, self.counts, self.moves, self.mass = numbers, label, counts, moves, mass
        self.known = len(counts)
        rest = np.zeros(len(label) - len(counts))
        self.logs, self.seen = np.concatenate([np.log10(counts + 1.0), rest]), np.concatenate([counts > 0, rest > 0])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in pieces_of(batches):
            out: list[list] = [[], [], [], [], []]
            for text in texts(batch.column("_text")):
                words = blank_words(text)
                words.append(END)
                at = m.numbers.of(words)
                own = m.label[at]
                moves = m.moves[np.concatenate([[m.label[m.numbers[END]]], own[:-1]]), own]
                rare = Counter(words[i].decode() for i in np.flatnonzero(at >= m.known))
                values = (len(words), int(m.seen[at].sum()), float(m.logs[at].sum()), float((moves - m.mass[own]).sum()),
                          [{"word": w, "n": n} for w, n in rare.items()])
                for column, value in zip(out, values):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())])))
            kept = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, *[pa.array(c, k) for c, k in zip(out, kinds)]], names=[*kept.schema.names, "n_tokens", "n_known", "logs", "shape", "rare"]
            )

    return run


def _frequent(counts: DataFrame) -> DataFrame:
    """The most frequent words, at most KNOWN of them and none longer than LONGEST, by a least count from a histogram of counts."""
    short = counts.where(F.octet_length("word") <= LONGEST).withColumn("level", F.floor(F.log2("n") * 16))
    words, least = 0, None
    for r in short.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():  # 1024 rows at most
        words += r["words"]
        if words > KNOWN:
            break
        least = r["level"]
    return short.where(F.col("level") >= F.lit(least)).select("word", "n")


def trained(counts: DataFrame, train: DataFrame, total: int) -> Model:
    """The model from the table of counts and the training texts (column ``_text``)."""
    spark = counts.sparkSession
    held = {w.encode(): n for w, n in zip(*(c.to_pylist() for c in _frequent(counts).toArrow().columns))}
    if END not in held:
        held |= {END: r["n"] for r in counts.where(F.col("word") == END.decode()).collect()}
    words = [END, *sorted((w for w in held if w != END), key=lambda w: (-held[w], w))]
    send = spark.sparkContext.broadcast
    units = words[: WORD_UNITS + 1]
    endings = (
        counts.mapInArrow(_endings(send(frozenset(units))), "ending binary, n long").groupBy("ending").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "ending").limit(ENDING_UNITS).collect()
    )
    tails = [bytes(r["ending"]) for r in endings]
    small, numbers = Numbers(units, tails), Numbers(words, tails)
    size, sent = small.other + 1, send(numbers)
    # The texts become numbers once; every further pass reads these.
    coded = written(train.mapInArrow(_coded(sent), "ids binary"), "coded-texts")
    unit_of = np.array([small[w] for w in words] + list(range(len(units), size)), dtype=np.int64)
    rows = coded.mapInArrow(_pairs(send(unit_of), size), "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros((size, size))
    pairs[rows.column("a").to_numpy(), rows.column("b").to_numpy()] = rows.column("n").to_numpy()
    of_unit = exchange_classes(pairs)

    often = sum(1 for w in words if w != END and held[w] >= LEAST) + 1  # words are in the order of their counts, behind the end
    label, moves = exchanged(coded, of_unit[unit_of], len(units), max(often, len(units)), ROUNDS)
    sizes = counts.mapInArrow(_class_sizes(sent, send(label)), "class long, n long, kinds long").groupBy("class").agg(
        F.sum("n").alias("n"), F.sum("kinds").alias("kinds")
    ).collect()  # one row per class
    n, kinds = np.zeros(len(moves)), np.zeros(len(moves))
    for r in sizes:
        n[r["class"]], kinds[r["class"]] = r["n"], r["kinds"]
    base = (n + 1) / (total + len(n))
    moves = (moves + PRIOR * base[None]) / (moves.sum(1, keepdims=True) + PRIOR)
    return Model(numbers, label, np.array([held.get(w, 0) for w in words], dtype=np.float64), np.log10(moves), np.log10(n + kinds + 1))


def scored(docs: DataFrame, held_out, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    ``held_out`` is a Boolean column; the rows for which it is not true train the model. A null text is empty: its end is
    its one token. Without training rows every probability rests on the counts of unseen words alone.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(f"`{text}`").cast("string").alias("_text"))
    train = rows.where(~F.col("held_out")).select("_text")
    counts = written(train.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("kinds")).first()
    model = docs.sparkSession.sparkContext.broadcast(trained(counts, train, size["n"]))
    id_type = rows.schema["id"].dataType.simpleString()
    form = f"id {id_type}, held_out boolean, n_tokens long, n_known long, logs double, shape double, rare array<struct<word: string, n: long>>"
    first = written(rows.mapInArrow(_score(model), form).withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = (
        first.select("row", F.explode("rare").alias("r")).select("row", "r.word", F.col("r.n").alias("times"))
        .join(counts, "word").groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more"), F.sum("times").alias("seen"))
    )
    logs = F.col("logs") + F.coalesce("more", F.lit(0.0))
    unit = F.lit(float(size["n"] + size["kinds"] + 1))
    return first.drop("rare").join(rare, "row", "left").select(
        F.col("id").alias(id_column), "held_out", "n_tokens", (F.col("n_known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(size["n"]).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * F.log10(unit)).alias("base_score"),
        (logs + F.col("shape")).alias("score"),
    )


def op8_brown(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scored(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2)
