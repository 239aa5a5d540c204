"""Vector codes by product quantization: integer codebooks, fitted by Lloyd rounds that touch active entries only.

Components become integers (``floor(scale * x)``) and each vector is cut in equal parts, each with a codebook of its
own. A round assigns every part to its nearest entry and moves each entry to the floored mean of its parts. All arithmetic is on integers, so
results do not depend on how rows are dealt out.

Every part carries its entry and its exact squared distance to it. After a move, a part whose entry stayed where it was
compares only the entries that moved with the stored distance; no other can have become nearer. A part whose entry moved scans all
entries. The lower index wins ties both ways.

A round is one job: the tasks assign, and send sums and counts, added up per batch, per task and then over all; the driver gets the totals of
the codebooks' entries only. The rows of the round before stay on the executors' disks; a lost one is made again from the input, as
each round's codebooks are part of its task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import hinted, kept, table

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 26  # greatest size of a scaled component: squared distances of a thousand of them fit a long
ROWS = 2048  # vectors worked on at once

STATE = "id long, label string, vector binary, code binary, distance binary, totals array<long>"


@dataclass
class Codebooks:
    """``entries``: part, entry, position. ``moved``: part, entry; those that the last update changed."""

    entries: np.ndarray
    moved: np.ndarray

    def updated(self, totals: np.ndarray) -> Codebooks:
        """Entries at the floored means of their parts; those without parts stay."""
        sums, count = totals[..., :-1], totals[..., -1:]
        new = np.where(count > 0, sums // np.maximum(count, 1), self.entries)
        return Codebooks(new, (new != self.entries).any(axis=2))

    def digest(self) -> str:
        """Of all components as decimal numbers, by part, entry and position."""
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def assign(vectors: np.ndarray, books: Codebooks, code: np.ndarray | None = None, distance: np.ndarray | None = None):
    """Nearest entry of each part and its squared distance (rows x parts), from those of the round before if given."""
    rows, parts = len(vectors), len(books.entries)
    cut = vectors.reshape(rows, parts, -1)
    first = code is None
    code = np.zeros((rows, parts), np.int64) if first else code.astype(np.int64)
    distance = np.zeros((rows, parts), np.int64) if first else distance.copy()
    for p in range(parts):
        entries, moved = books.entries[p], books.moved[p]
        whole = np.ones(rows, bool) if first else moved[code[:, p]]
        some = np.flatnonzero(whole)
        if len(some):
            far = _distances(cut[some, p], entries)
            code[some, p] = far.argmin(axis=1)
            distance[some, p] = far.min(axis=1)
        some, active = np.flatnonzero(~whole), np.flatnonzero(moved)
        if len(some) and len(active):
            far = _distances(cut[some, p], entries[active])
            best = active[far.argmin(axis=1)]
            far = far.min(axis=1)
            nearer = (far < distance[some, p]) | ((far == distance[some, p]) & (best < code[some, p]))
            code[some[nearer], p] = best[nearer]
            distance[some[nearer], p] = far[nearer]
    return code, distance


def _distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points[:, None] - entries[None]) ** 2).sum(axis=2)


def _totals(vectors: np.ndarray, code: np.ndarray, entries: int) -> np.ndarray:
    """Sums of the components of each entry's parts, and behind them their number."""
    rows, parts = code.shape
    cut = vectors.reshape(rows, parts, -1)
    out = np.zeros((parts, entries, cut.shape[2] + 1), np.int64)
    for p in range(parts):
        np.add.at(out[p, :, :-1], code[:, p], cut[:, p])
        out[p, :, -1] = np.bincount(code[:, p], minlength=entries)
    return out


def _numbers(column: pa.Array, kind, rows: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(rows, -1).astype(np.int64)


def _packed(values: np.ndarray, kind) -> pa.Array:
    return pa.array([row.tobytes() for row in values.astype(kind)], pa.binary())


def _scaled(scale: int):
    """Rows before the first round: scaled vectors, neither codes nor distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            vectors = np.floor(flat * scale).reshape(batch.num_rows, -1)
            nothing = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), _packed(vectors, "<i4"), nothing, nothing, pa.nulls(batch.num_rows, pa.list_(pa.int64()))],
                names=["id", "label", "vector", "code", "distance", "totals"])

    return run


def _round(books: Codebooks):
    """Every row with new codes and distances, and after each batch a row with its totals only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS):
                rows = batch.slice(low, ROWS)
                n = rows.num_rows
                vectors = _numbers(rows.column("vector"), "<i4", n)
                before = rows.column("code").null_count == 0
                code, distance = assign(
                    vectors, books,
                    _numbers(rows.column("code"), "<u2", n) if before else None, _numbers(rows.column("distance"), "<i8", n) if before else None)
                totals = _totals(vectors, code, books.entries.shape[1]).reshape(-1)
                names = ["id", "label", "vector", "code", "distance", "totals"]
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in names[:3]), _packed(code, "<u2"), _packed(distance, "<i8"), pa.nulls(n, pa.list_(pa.int64()))], names=names)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, rows.schema.field(c).type) for c in names[:5]] + [pa.array([totals.tolist()], pa.list_(pa.int64()))], names=names)

    return run


def sound(vector: Column, largest: float) -> Column:
    """Whether a vector is there and all its components are, finite, and no larger than ``largest`` either way."""
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(float(largest)))), F.lit(False))


def vector_codes(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """The id, ``code`` (two hex digits a part, at most 256 entries), ``error``, ``label_error`` of every row kept, and the codebooks.

    Left out are rows whose vector is null or empty, or holds a null, a component that is not finite or is over LARGEST once
    scaled; of vectors of several lengths, those keep out that differ in length from the smallest id's among lengths that ``parts``
    divides. Repeated ids are rows of their own (the first codebooks order them by their components); a row without id counts as
    the largest. With fewer rows than ``entries`` the codebooks have one entry a row; without rows they are empty. ``label_error`` adds ``error``
    over equal labels, rows without label together. Other columns play no part.
    """
    named = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"))
    able = named.where(sound(F.col("vector"), LARGEST / scale) & (F.size("vector") > 0) & (F.size("vector") % parts == 0))
    by_id = [F.col("id").asc_nulls_last(), F.col("vector")]
    first = able.orderBy(*by_id).select(F.size("vector").alias("dim")).first()
    dim = first["dim"] if first else parts
    able = able.where(F.size("vector") == dim)
    start = [r["vector"] for r in able.orderBy(*by_id).limit(entries).select("vector").collect()]
    cut = np.floor(np.array(start, dtype=np.float64).reshape(len(start), dim) * scale).astype(np.int64).reshape(len(start), parts, dim // parts)
    books = Codebooks(np.ascontiguousarray(cut.transpose(1, 0, 2)), np.ones((parts, len(start)), bool))
    state = kept(able.mapInArrow(_scaled(scale), STATE))
    if start:
        for turn in range(rounds + 1):
            old, state = state, kept(state.where("vector is not null").mapInArrow(_round(books), STATE))
            if turn == rounds:
                break
            # As many rows as the codebooks have components, and one count for each entry.
            sums = state.where("totals is not null").select(F.posexplode("totals").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).toArrow()
            totals = np.zeros(books.entries.size + books.moved.size, np.int64)
            totals[sums.column("at").to_numpy()] = sums.column("n").to_numpy()
            books = books.updated(totals.reshape(*books.moved.shape, -1))
            old.unpersist()
    return _described(state.where("vector is not null"), id_column, parts), books


def _texts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            code, distance = _numbers(batch.column("code"), "<u2", batch.num_rows), _numbers(batch.column("distance"), "<i8", batch.num_rows)
            texts = ["".join(f"{x:02x}" for x in row) for row in code.tolist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(texts, pa.string()), pa.array(distance.sum(axis=1), pa.int64())],
                names=["id", "label", "code", "error"])

    return run


def _described(state: DataFrame, id_column: str, parts: int) -> DataFrame:
    done = state.mapInArrow(_texts(parts), "id long, label string, code string, error long")
    by_label = kept(done.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")))
    width = 64 + (by_label.agg(F.max(F.octet_length("of")).alias("n")).first()["n"] or 0)
    return done.join(hinted(by_label, width), F.col("label").eqNullSafe(F.col("of"))).select(
        F.col("id").alias(id_column), "code", "error", "label_error")


def op11_active_lloyd(spark, sf_dir: str) -> DataFrame:
    codes, books = vector_codes(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return codes.withColumn("codebooks_sha256", F.lit(books.digest()))
