"""Document quality by attention over passages (multiple-instance learning).

A document is a bag of passages of about 512 bytes, its whole text. Each passage gives shares of character
kinds, shape and repetition of its words, and a histogram of hashed byte pairs. A small network encodes every
passage, gated attention (tanh times sigmoid) weighs them, and the weighted sum is scored; only documents have labels, so the
weights are learned from those. Training is on the driver over the passages of a bounded sample of labelled
documents; scoring runs in the tasks that read the documents, nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import bounded_sample, pieces_of, table, with_text

SAMPLE = 4_000  # labelled documents that train the model
SAMPLE_BYTES = 100_000  # of a document that may be in the sample
PASSAGE = 512
THRESHOLD = 0.7
PAIRS = 64  # buckets of byte pairs
HIDDEN, GATE = 16, 8
EPOCHS, BATCH, RATE, DECAY = 40, 64, 4e-3, 1e-3
SHORT = 256  # a passage of so many bytes counts half
RUN = 150_000  # bytes worked on at once


def _kinds() -> np.ndarray:
    """The kind of each byte; 15 kinds."""
    kinds = np.full(256, 14)
    for number, chars in enumerate([
        b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b"\t", b".", b",", b"?!;:", b"'\"`",
        b"#$%&*@^~|<>=+\\/_", b"()[]{}-",
    ]):
        kinds[list(chars)] = number
    kinds[0x80:0xC0], kinds[0xC0:] = 12, 13
    return kinds


KINDS = _kinds()
N_KINDS = 15
WEIGHTS = np.random.default_rng(3).integers(1, 1 << 62, size=64, dtype=np.uint64)
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
WIDTH = N_KINDS + 9 + PAIRS  # and the weight of the passage behind them


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages of the texts, and the number of passages of each (an empty text has one)."""
    rows, counts = [], []
    low, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= RUN or k + 1 == len(texts):
            x, n = _run(texts[low : k + 1])
            rows.append(x)
            counts.append(n)
            low, size = k + 1, 0
    return (np.concatenate(rows), np.concatenate(counts)) if rows else (np.zeros((0, WIDTH + 1), np.float32), np.zeros(0, np.int64))


def _run(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    # A line end behind each text keeps the words of neighbours apart and gives empty texts a passage.
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    sizes = np.array([len(t) + 1 for t in texts])
    starts = np.cumsum(sizes) - sizes
    each = np.maximum(1, -(-sizes // PASSAGE))
    owner = np.repeat(np.arange(len(texts)), each)
    first = starts[owner] + PASSAGE * (np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each))
    passage = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(data))))
    count = len(first)
    length = np.bincount(passage, minlength=count).astype(np.float64)
    kinds = np.bincount(passage * N_KINDS + KINDS[data], minlength=count * N_KINDS).reshape(count, N_KINDS) / length[:, None]

    blank = BLANK[data]
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    words = np.zeros((count, 9))
    if len(begin):
        end = np.flatnonzero(blank & np.concatenate([[False], ~blank[:-1]]))
        size = end - begin
        # A word lies in the passage of its first byte.
        at = passage[begin]
        inside = np.flatnonzero(~blank)
        place = inside - np.repeat(begin, size)
        shifted = (data[inside].astype(np.uint64) + np.uint64(1)) * WEIGHTS[place & 63] * (place.astype(np.uint64) // np.uint64(64) + np.uint64(1))
        code = np.add.reduceat(shifted, np.cumsum(size) - size)
        total = np.maximum(np.bincount(at, minlength=count), 1)
        share = lambda mask: np.bincount(at[mask], minlength=count) / total
        again = np.zeros(len(code), dtype=bool)
        again[1:] = (code[1:] == code[:-1]) & (at[1:] == at[:-1])
        order = np.lexsort((code, at))
        twice = (code[order][1:] == code[order][:-1]) & (at[order][1:] == at[order][:-1])
        last, head = KINDS[data[end - 1]], KINDS[data[begin]]
        words = np.stack([
            np.bincount(at, minlength=count) / length * 8, np.log1p(np.bincount(at, weights=size, minlength=count) / total),
            share(size <= 3), share(size >= 10), share(again), np.bincount(at[order][1:][twice], minlength=count) / total,
            share(last == 10), share((size == 1) & (head == 10)), share((last == 6) | (last == 7)),
        ], axis=1)
    pair = ((data[:-1].astype(np.int64) * 31 + data[1:]) * 2654435761 >> 16) & (PAIRS - 1)
    # None begins at the end of a text: a score does not depend on the text that happens to be next.
    inner = np.ones(len(data) - 1, dtype=bool)
    inner[starts[1:] - 1] = False
    pairs = np.bincount((passage[:-1] * PAIRS + pair)[inner], minlength=count * PAIRS).reshape(count, PAIRS) / length[:, None]
    weight = (length / (length + SHORT))[:, None]
    return np.concatenate([np.sqrt(kinds), words, np.sqrt(pairs), weight], axis=1).astype(np.float32), each


@dataclass
class Model:
    """Weights of the network; ``mean`` and ``scale`` bring features to a common range."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def scores(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        if not len(counts):
            return np.zeros(0)
        return _sigmoid(_forward(self.weights, self.scaled(x), counts)["logit"].astype(np.float64))

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """Features around zero; short passages, whose shares are chance, stay close to it."""
        return (x[:, :WIDTH] - self.mean) / self.scale * x[:, WIDTH:]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _forward(w: dict, x: np.ndarray, counts: np.ndarray) -> dict:
    starts = np.cumsum(counts) - counts
    h = np.tanh(x @ w["encode"] + w["encode_bias"])
    t, g = np.tanh(h @ w["value"]), _sigmoid(h @ w["gate"])
    e = (t * g) @ w["attend"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), counts))
    a = e / np.repeat(np.add.reduceat(e, starts), counts)
    z = np.add.reduceat(a[:, None] * h, starts)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "logit": z @ w["out"] + w["bias"]}


def _gradients(w: dict, x: np.ndarray, counts: np.ndarray, y: np.ndarray) -> dict:
    v = _forward(w, x, counts)
    starts = np.cumsum(counts) - counts
    d_logit = (_sigmoid(v["logit"]) - y) / len(y)
    d_z = np.repeat(d_logit[:, None] * w["out"][None], counts, axis=0)
    d_a = (d_z * v["h"]).sum(1)
    d_e = v["a"] * (d_a - np.repeat(np.add.reduceat(v["a"] * d_a, starts), counts))
    d_tg = d_e[:, None] * w["attend"][None]
    d_t, d_g = d_tg * v["g"] * (1 - v["t"] ** 2), d_tg * v["t"] * v["g"] * (1 - v["g"])
    d_h = v["a"][:, None] * d_z + d_t @ w["value"].T + d_g @ w["gate"].T
    d_u = d_h * (1 - v["h"] ** 2)
    return {
        "encode": x.T @ d_u, "encode_bias": d_u.sum(0), "value": v["h"].T @ d_t, "gate": v["h"].T @ d_g,
        "attend": (v["t"] * v["g"]).T @ d_e, "out": v["z"].T @ d_logit, "bias": np.array(d_logit.sum()),
    }


def fit(x: np.ndarray, counts: np.ndarray, y: np.ndarray, seed: int = 11) -> Model:
    """Adam on the log loss of the documents' labels. Without documents every score is 0.5."""
    rng = np.random.default_rng(seed)
    mean = x[:, :WIDTH].mean(0) if len(x) else np.zeros(WIDTH, np.float32)
    scale = np.maximum(x[:, :WIDTH].std(0), 0.02) if len(x) else np.ones(WIDTH, np.float32)
    draw = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
    w = {
        "encode": draw(WIDTH, HIDDEN), "encode_bias": np.zeros(HIDDEN, np.float32), "value": draw(HIDDEN, GATE), "gate": draw(HIDDEN, GATE),
        "attend": draw(GATE), "out": np.zeros(HIDDEN, np.float32), "bias": np.array(0, np.float32),
    }
    if len(y):
        x, y = Model(mean, scale, w).scaled(x), y.astype(np.float32)
        stops = np.cumsum(counts)
        places = [np.arange(stop - n, stop) for stop, n in zip(stops, counts)]
        first, second, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(y))
            for low in range(0, len(y), BATCH):
                some = order[low : low + BATCH]
                grads = _gradients(w, x[np.concatenate([places[i] for i in some])], counts[some], y[some])
                step += 1
                for k, g in grads.items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    w[k] = (w[k] - rate * (first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8) + DECAY * w[k])).astype(np.float32)
    return Model(mean, scale, w)


def _texts(column: pa.Array) -> list[bytes]:
    return [x.as_py() or b"" for x in column.cast(pa.large_string()).cast(pa.large_binary())]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces_of(batches):
        x, counts = passages(_texts(batch.column("_text")))
        stops = np.cumsum(counts)
        rows = [x[stop - n : stop].tobytes() for stop, n in zip(stops, counts)]
        yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.binary())], names=["label", "passages"])


def _scorer(model, text: str, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches, text):
            x, counts = passages(_texts(batch.column(text)))
            kept = batch.select(keep)
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(model.value.scores(x, counts))], names=[*kept.schema.names, "score"])

    return run


def held_out(id_column: str = "doc_id") -> Column:
    """The rows that never train; a row without id may."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string")) % 4 == 2, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> Model:
    """A model from about ``sample`` labelled documents that are not held out, picked by the hash of their id.

    Labels other than 0 and 1, ids with both, and texts of more than SAMPLE_BYTES are passed over; of documents that repeat an id each counts.
    """
    clean = (
        labels.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").cast("int").alias("label")).where("id is not null and label in (0, 1)")
        .groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
        .where(~held_out("id")).select("id", "label")
    )
    clean = bounded_sample(clean, F.col("id").cast("string"), sample)
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text}`").cast("string").alias("_text"))
    short = rows.where(F.octet_length("_text") <= SAMPLE_BYTES).join(F.broadcast(clean), "id")
    # Ids may repeat among the documents.
    short = bounded_sample(short, F.col("_text"), 2 * sample).orderBy("id", "_text")
    got = short.select("label", "_text").mapInArrow(_featured, "label int, passages binary").toArrow()
    x = [np.frombuffer(p, dtype=np.float32).reshape(-1, WIDTH + 1) for p in got.column("passages").to_pylist()]
    return fit(np.concatenate(x) if x else np.zeros((0, WIDTH + 1), np.float32), np.array([len(p) for p in x]), got.column("label").to_numpy().astype(float))


def scored(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with the columns ``keep`` (all) and ``score`` (0 to 1); a null text is empty. A column of that name is replaced."""
    kept = [c for c in (docs.columns if keep is None else keep) if c != "score"]
    rows, name = with_text(docs, kept, text)
    send = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_scorer(send, name, kept), rows.select(*[F.col(f"`{c}`") for c in kept]).schema.add("score", "double"))


def op9_attention_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = trained(docs, table(spark, sf_dir, "labels"))
    return scored(docs, model, keep=["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted")
    )
