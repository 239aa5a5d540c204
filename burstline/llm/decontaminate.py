"""Benchmark decontamination by a broadcast set of word windows.

Every window of ``n`` consecutive words of a benchmark item (an item of fewer words is one window) is
numbered over the benchmark's own words. Where the benchmark was measured to fit, each task holds the
set of windows, turns a document into word numbers, finds places where a window's words are all known
and its hash is in the set, and compares the words themselves. Documents never move. A benchmark
too large for that is joined with the documents' windows by shuffle.

Nulls: a null text has no words, hence no hits; an item without words has no window.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burstline.llm.common import pieces_of, plain_words, table, with_text, written

WINDOW = 10
# A task's copy of the windows takes some 150 bytes a word; the benchmark's bytes are counted before.
BROADCAST_TEXT = 8 * 1024 * 1024
PRIME = np.uint64(0x9E3779B97F4A7C15)

NEW = [
    T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("items", T.ArrayType(T.StringType())),
]


class Windows:
    """The windows of some items: ``find`` gives the hit places and items of a document."""

    def __init__(self, items: list[tuple[str, bytes]], n: int = WINDOW):
        self.number: dict[bytes, int] = {}
        held: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            words = [self.number.setdefault(w, len(self.number) + 1) for w in plain_words(text)]
            size = min(n, len(words))
            for i in range(len(words) - size + 1 if size else 0):
                held.setdefault(size, {}).setdefault(tuple(words[i : i + size]), set()).add(item)
        self.sizes = {}
        for size, windows in held.items():
            hashes = self._hashes(np.array(list(windows), dtype=np.int64).reshape(-1), size, step=size)
            self.sizes[size] = (np.unique(hashes), windows)

    @staticmethod
    def _hashes(ids: np.ndarray, size: int, step: int = 1) -> np.ndarray:
        """A hash of each window, by places 0, step, 2 * step and so on."""
        count = (len(ids) - size) // step + 1
        total = np.zeros(count, dtype=np.uint64)
        for k in range(size):
            total = total * PRIME + ids[k : k + (count - 1) * step + 1 : step].astype(np.uint64)
            total ^= total >> np.uint64(29)
        return total

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Hit word places as (start, end) runs, and the items whose windows occur."""
        get = self.number.get
        ids = np.array([get(w, 0) for w in words], dtype=np.int64)
        known = np.concatenate([[0], np.cumsum(ids > 0)])
        hit, items = np.zeros(len(ids) + 1, dtype=np.int64), set()
        for size, (hashes, windows) in self.sizes.items():
            if len(ids) < size:
                continue
            full = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(full):
                continue
            some = ids[full[:, None] + np.arange(size)]
            total = self._hashes(some.reshape(-1), size, step=size)
            at = np.searchsorted(hashes, total)
            same = (at < len(hashes)) & (hashes[np.minimum(at, len(hashes) - 1)] == total)
            for row in np.flatnonzero(same):
                owners = windows.get(tuple(some[row].tolist()))
                if owners:
                    items |= owners
                    hit[full[row]] += 1
                    hit[full[row] + size] -= 1
        inside = np.diff(np.concatenate([[0], (np.cumsum(hit) > 0).astype(np.int8), [0]]))
        return list(zip(np.flatnonzero(inside == 1).tolist(), np.flatnonzero(inside == -1).tolist())), items


def _bytes(column: pa.Array) -> Iterator[bytes | None]:
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py()


def _scan(windows, text: str, keep: list[str]):
    """Adds n_words, spans and items to each row of an Arrow batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = windows.value
        for batch in pieces_of(batches, text):
            counts, spans, items = [], [], []
            for raw in _bytes(batch.column(text)):
                words = plain_words(raw)
                places, found = held.find(words)
                counts.append(len(words))
                spans.append([list(p) for p in places])
                items.append(sorted(found))
            arrays = [batch.column(c) for c in keep] + [
                pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "n_words", "spans", "items"])

    return run



def _grams(n: int, sizes: list[int]):
    """A row for each window of a text: (place, words joined by blanks); ``owner`` is carried along."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            for owner, text in zip(batch.column("owner"), _bytes(batch.column("_text"))):
                words = [w.decode() for w in plain_words(text)]
                own = [min(n, len(words))] if not sizes else [s for s in sizes if s <= len(words)]
                for size in filter(None, own):
                    for low in range(0, len(words) - size + 1, 10_000):
                        places = range(low, min(low + 10_000, len(words) - size + 1))
                        yield pa.RecordBatch.from_arrays([
                            pa.array([owner.as_py()] * len(places), owner.type), pa.array(places, pa.int64()),
                            pa.array([size] * len(places), pa.int64()),
                            pa.array([" ".join(words[i : i + size]) for i in places], pa.string()),
                        ], names=["owner", "place", "size", "gram"])

    return run


def _joined(rows: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """The same hits by a shuffled join of windows, for a benchmark of any size."""
    form = "owner {}, place long, size long, gram string"
    grams = (
        items.select(F.col("item").alias("owner"), F.col("text").cast("string").alias("_text"))
        .mapInArrow(_grams(n, []), form.format("string"))
        .groupBy("size", "gram").agg(F.collect_set("owner").alias("found"))
    )
    grams = written(grams, "benchmark-windows")
    sizes = [r["size"] for r in grams.select("size").distinct().collect()]  # 1 to n
    numbered = written(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered-documents")
    hits = (
        numbered.select(F.col("_row").alias("owner"), "_text").mapInArrow(_grams(n, sizes or [n]), form.format("long"))
        .join(grams, ["size", "gram"])
        .groupBy("owner").agg(
            F.sort_array(F.collect_list(F.array("place", F.col("place") + F.col("size")))).alias("found_spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("found")))).alias("items"),
        )
    )
    # Runs that touch become one; the list is as long as the document at most.
    merged = F.aggregate(
        "found_spans", F.array().cast("array<array<bigint>>"),
        lambda done, s: F.when(
            (F.size(done) > 0) & (F.element_at(F.element_at(done, -1), 2) >= s[0]),
            F.concat(
                F.slice(done, F.lit(1), F.size(done) - 1),
                F.array(F.array(F.element_at(F.element_at(done, -1), 1), F.greatest(F.element_at(F.element_at(done, -1), 2), s[1]))),
            ),
        ).otherwise(F.concat(done, F.array(s))),
    )
    empty = F.array().cast("array<string>")
    words = F.size(F.filter(F.split(lowered("_text"), WORD_BREAK), lambda w: w != ""))
    return numbered.join(hits, numbered["_row"] == hits["owner"], "left").withColumns({
        "n_words": F.coalesce(F.when(F.col("_text").isNotNull(), words).cast("long"), F.lit(0).cast("long")),
        "spans": F.coalesce(merged, F.array().cast("array<array<bigint>>")), "items": F.coalesce("items", empty),
    }).drop("_row", "owner", "found_spans")


WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: str) -> Column:
    return F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


Then = tuple[Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], T.StructType]


def find_hits(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    n: int = WINDOW, limit: int | None = None, keep: list[str] | None = None, then: Then | None = None,
) -> DataFrame:
    """All rows of ``docs``, the columns ``keep`` (all) with ``n_words``, ``spans`` (runs of hit words, [from, to)) and ``items``.

    ``items`` are the item ids as strings, sorted. Columns of ``docs`` with these names are replaced. Items without id
    or words are passed over; several items with one id count as one, and repeated documents are each judged.
    ``then`` (a step for ``mapInArrow`` and its schema) goes on with these rows, in the same task where possible.
    """
    new = [f.name for f in NEW]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in new]
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), F.col(f"`{item_text}`").alias("text")).where(
        "item is not null and length(text) > 0"
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    if size <= (BROADCAST_TEXT if limit is None else limit):
        windows = docs.sparkSession.sparkContext.broadcast(Windows([(r["item"], r["text"].encode()) for r in items.collect()], n))
        rows, name = with_text(docs, kept, text)
        fields = rows.select(*[F.col(f"`{c}`") for c in kept]).schema.fields
        scan = _scan(windows, name, kept)
        if then:
            # One Python step: the texts do not go back and forth once more.
            step, schema = then
            return rows.mapInArrow(lambda batches: step(scan(batches)), schema)
        rows = rows.mapInArrow(scan, T.StructType([*fields, *NEW]))
    else:
        rows = _joined(docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_text")), items, n)
    found = rows.select(*[F.col(f"`{c}`") for c in kept], *new)
    return found.mapInArrow(*then) if then else found


def _without_spans(most: float):
    """The other columns and the text without its spans, of documents that have no more than the share ``most`` of their words in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces_of(iter([whole]), "_whole")):
            rows, texts = [], []
            for row, (text, n, spans) in enumerate(zip(_bytes(batch.column("_whole")), batch.column("n_words").to_pylist(), batch.column("spans").to_pylist())):
                if sum(end - start for start, end in spans) > n * most:
                    continue
                if spans:
                    ends = [m.span() for m in WORD.finditer(text)]
                    cut, at = [], 0
                    for start, end in spans:
                        cut.append(text[at : ends[start][0]])
                        at = ends[end - 1][1]
                    text = b"".join([*cut, text[at:]])
                rows.append(row)
                texts.append(None if text is None else text.decode())
            yield pa.RecordBatch.from_arrays([batch.column("_doc").take(pa.array(rows, pa.int64())), pa.array(texts, pa.string())], names=["_doc", "_whole"])

    return run


WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, remove: str = "spans", most: float = 0.5, text: str = "text", **options
) -> DataFrame:
    """``docs`` without benchmark passages, same columns.

    ``remove="documents"`` drops every document with a hit. ``remove="spans"`` cuts the hit words, with what
    stands between them, out of the text, and drops documents of whose words more than the share ``most`` is hit.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be spans or documents, not {remove}")
    if remove == "documents":
        nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"), F.col(f"`{text}`"))
        found = find_hits(nested, benchmark, text, keep=["_doc"], **options)
        return found.where(F.size("spans") == 0).select(*[F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])
    others = [F.col(f"`{c}`") for c in docs.columns if c != text] or [F.lit(None).cast("string").alias("_none")]
    nested = docs.select(F.struct(*others).alias("_doc"), F.col(f"`{text}`").cast("string").alias("_whole"))
    clean = find_hits(nested, benchmark, "_whole", keep=["_doc", "_whole"], then=(_without_spans(most), nested.schema), **options)
    return clean.select(*[F.col("_whole").alias(c) if c == text else F.col(f"_doc.`{c}`").alias(c) for c in docs.columns])


def hit_words() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])


def op1_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    n_hit = hit_words()
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
