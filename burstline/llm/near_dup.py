"""Near-duplicate documents by HyperMinHash.

1. A task turns each text into its set of word shingles and keeps 128 registers (leading zeros and ten bits
   behind the leading one of the smallest hash per bucket). Documents with equal sets become one class; only
   the registers of one document of each class go on.
2. Registers are banded as the threshold asks (0.85: 25 bands of five, 0.80: 28 of four): classes that share a band meet in a bucket. Every class
   is compared with the first one of its bucket. Similarity estimated from equal registers, corrected
   for those equal by chance, leaves out what is far below the threshold; the others are decided on the full sets.
3. Buckets of three and more that these links leave in several components are searched further: rows with
   512 registers are compared block against block, the component of the bucket's first class only with the rest. Classes
   with a pair that the finer estimate leaves open go on, with their full sets, to a task for each two blocks, which counts the common
   shingles of all their pairs at once and gives out a forest of the links. No table of pairs is formed: a family of
   texts just below the threshold costs rows in proportion to its members.
4. Components of all links.

Copies are never paired: they share a class. What can be missed is bounded by the parameters: pairs at the
threshold that share no band (4 in 10,000,000), and estimates more than five (four, for the finer one) standard errors too low.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import hinted, kept, pieces_of, table, written
from burstline.llm.components import components
from burstline.llm.shingles import (
    BUCKETS, FINE, SHINGLE, WordHashes, band_keys, bands_for, estimate, fine_estimate, fine_registers, registers, shingle_set,
)

PERCENT = 85  # of 100: the least similarity of a link in op7_minhash; the pipeline's stage has its own
BLOCK = 1024  # classes of one bucket compared by one task
BLOCK_SHINGLES = 1 << 20  # and distinct shingles of these, about: 8 MB
COLUMNS = 4096  # shingles counted at once


def row_key(id_column: str, text: str) -> Column:
    """Tells rows apart by id and text, with 128 bits; nulls are told apart from empty texts."""
    parts = [F.col(f"`{id_column}`").cast("string"), F.col(f"`{text}`"), F.col(f"`{text}`").isNull()]
    return F.concat(F.hex(F.xxhash64(*parts)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *parts)))


def _texts(column: pa.Array) -> Iterator[bytes | None]:
    for value in column.cast(pa.large_string()).cast(pa.large_binary()):
        yield value.as_py()


def _fingerprint(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _sketcher(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in pieces_of(batches):
            sizes, prints, sketches = [], [], []
            for text in _texts(batch.column("_text")):
                hashes = shingle_set(text, known, n)
                sizes.append(len(hashes))
                prints.append(_fingerprint(hashes) if len(hashes) else None)
                sketches.append(registers(hashes).tobytes() if len(hashes) else None)
            kept = batch.drop_columns(["_text"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), pa.array(sketches, pa.binary())],
                names=[*kept.schema.names, "n_shingles", "print", "sketch"],
            )

    return run


def _bands(percent: int):
    bands, rows = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = np.frombuffer(b"".join(batch.column("sketch").to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS)
            keys = band_keys(sketches, bands, rows)
            nodes = np.repeat(batch.column("node").to_numpy(), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(nodes)], names=["bucket", "node"])

    return run


def _set_maker(n: int, percent: int):
    """Full sets of candidate classes, with their band keys and fine registers; other texts of the same key are passed over."""
    bands, rows = bands_for(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in pieces_of(batches):
            nodes, sizes, keys, fine, sets = [], [], [], [], []
            for node, print_, text in zip(batch.column("node").to_pylist(), batch.column("print").to_pylist(), _texts(batch.column("_text"))):
                hashes = shingle_set(text, known, n)
                if _fingerprint(hashes) != print_:
                    continue
                nodes.append(node)
                sizes.append(len(hashes))
                keys.append(band_keys(registers(hashes)[None], bands, rows)[0].tobytes())
                fine.append(fine_registers(hashes).tobytes())
                sets.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), *[pa.array(x, pa.binary()) for x in (keys, fine, sets)]],
                names=["node", "n", "keys", "fine", "hashes"],
            )

    return run


def _likely(percent: int):
    """Pairs whose sketches may belong to sets as similar as asked for: five standard errors and the sizes allow it."""
    least = percent / 100 - 5 * (percent / 100 * (1 - percent / 100) / BUCKETS) ** 0.5

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype=np.uint16).reshape(-1, BUCKETS) for c in ("sketch_a", "sketch_b"))
            size_a, size_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            close = estimate(left, right, size_a, size_b) >= least
            close &= 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
            yield batch.select(["a", "b"]).filter(pa.array(close))

    return run


def _linked(percent: int):
    """Pairs whose full sets are as similar as asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                left, right = np.frombuffer(x.as_py(), dtype=np.uint64), np.frombuffer(y.as_py(), dtype=np.uint64)
                small, large = (left, right) if len(left) <= len(right) else (right, left)
                at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                common = int((large[at] == small).sum())
                out.append(100 * common >= percent * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

    return run


def _open_classes(percent: int):
    """Classes of one cell with a pair in different components that the fine registers leave open, and whose first common band this is."""
    share = percent / 100
    least = share - 4 * (share * (1 - share) / FINE) ** 0.5

    def run(rows: pa.Table) -> pa.Table:
        node, part, n, label = (rows.column(c).to_numpy() for c in ("node", "side", "n", "component"))
        fine = np.frombuffer(b"".join(rows.column("fine").to_pylist()), dtype=np.uint16).reshape(-1, FINE)
        keys = np.frombuffer(b"".join(rows.column("keys").to_pylist()), dtype=np.int64).reshape(len(node), -1)
        bucket, second = rows.column("bucket")[0].as_py(), rows.column("second")[0].as_py()
        left, right = np.flatnonzero(part == 0), np.flatnonzero(part == second)
        open_ = np.zeros(len(node), dtype=bool)
        for low in range(0, len(left), 256):
            i = left[low : low + 256]
            small, large = np.minimum(n[i][:, None], n[right][None]), np.maximum(n[i][:, None], n[right][None])
            able = (label[i][:, None] != label[right][None]) & (100 * small >= percent * large)
            # Within one block each pair once; between blocks all pairs are different.
            able &= node[i][:, None] < node[right][None] if second == 0 else True
            if not able.any():
                continue
            able &= fine_estimate(fine[i], fine[right]) >= least
            x, y = np.nonzero(able)
            for at in range(0, len(x), 4096):
                p, q = i[x[at : at + 4096]], right[y[at : at + 4096]]
                here = keys[p, (keys[p] == keys[q]).argmax(axis=1)] == bucket
                open_[p[here]] = open_[q[here]] = True
        some = np.flatnonzero(open_)
        return pa.table({c: rows.column(c).take(pa.array(some)) for c in ("bucket", "i", "kind", "j", "node", "side", "second")})

    return run


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many members every two sets have in common (left by right): products of incidence tables, some columns at a time."""
    sizes = np.array([len(x) for x in (*left, *right)])
    hashes = np.concatenate([np.zeros(0, np.uint64), *left, *right])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.argsort(hashes, kind="stable")
    hashes, owner = hashes[order], owner[order]
    new = np.concatenate([[True], hashes[1:] != hashes[:-1]]) if len(hashes) else np.zeros(0, bool)
    column = np.cumsum(new) - 1
    on_left = owner < len(left)
    # Only members that both sides have are counted.
    both = (np.bincount(column, weights=on_left) > 0) & (np.bincount(column, weights=~on_left) > 0) if len(hashes) else np.zeros(0, bool)
    number = np.cumsum(both) - 1
    keep = both[column]
    owner, column = owner[keep], number[column[keep]]
    out = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int(both.sum()), COLUMNS):
        first, last = np.searchsorted(column, [low, low + COLUMNS])
        table_ = np.zeros((len(sizes), COLUMNS), np.float32)
        table_[owner[first:last], column[first:last] - low] = 1
        out += table_[: len(left)] @ table_[len(left) :].T
    return out.astype(np.int64)


def _exact_links(percent: int):
    """Of the open classes of one cell: links of a forest that joins all that are linked, by their full sets."""

    def run(rows: pa.Table) -> pa.Table:
        node, part = rows.column("node").to_numpy(), rows.column("side").to_numpy()
        second = rows.column("second")[0].as_py()
        sets = [np.frombuffer(x.as_py(), dtype=np.uint64) for x in rows.column("hashes")]
        n = np.array([len(x) for x in sets])
        left, right = np.flatnonzero(part == 0), np.flatnonzero(part == second)
        common = common_counts([sets[k] for k in left], [sets[k] for k in right])
        near = 100 * common >= percent * (n[left][:, None] + n[right][None] - common)
        near &= node[left][:, None] < node[right][None] if second == 0 else True
        top = np.arange(len(node))

        def root(k: int) -> int:
            while top[k] != k:
                top[k] = top[top[k]]
                k = top[k]
            return k

        a, b = [], []
        for x, y in zip(*np.nonzero(near)):
            p, q = root(left[x]), root(right[y])
            if p != q:
                top[p] = q
                a.append(int(node[left[x]]))
                b.append(int(node[right[y]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    full = sets.select("node", "hashes")
    both = (
        pairs.join(full.withColumnsRenamed({"node": "a", "hashes": "set_a"}), "a")
        .join(full.withColumnsRenamed({"node": "b", "hashes": "set_b"}), "b")
    )
    return both.mapInArrow(_linked(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT, n: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: the id, ``row_key``, ``n_shingles``, ``group``, ``component_id`` and ``kept``.

    Documents are linked when 100 * common >= ``percent`` * all of their distinct ``n``-word shingles; ``component_id``
    is the smallest id reachable, ``kept`` whether it is the row's own. Texts without words are linked with nothing.
    ``group`` numbers the components by their classes of equal sets, whatever their ids; it is null without words.
    Rows with equal id and text all get the same; a row without id takes the component of what it is linked with
    and is kept only if nothing else of its component has an id, or it has no words.
    """
    rows = docs.select(F.col(f"`{id_column}`").alias("id"), row_key(id_column, text).alias("row_key"), F.col(f"`{text}`").cast("string").alias("_text"))
    id_type = rows.schema["id"].dataType.simpleString()
    made = rows.mapInArrow(_sketcher(n), f"id {id_type}, row_key string, n_shingles long, print binary, sketch binary")
    sketches = written(made.withColumn("row", F.monotonically_increasing_id()), "sketches")

    classes = written(
        sketches.where("print is not null").groupBy("print").agg(F.min("row").alias("node"), F.min("id").alias("first")), "classes"
    )
    chosen = kept(
        sketches.join(classes.select(F.col("node").alias("row")), "row")
        .select(F.col("row").alias("node"), "row_key", "n_shingles", "print", "sketch")
    )

    # Buckets with several classes, and the first of each.
    bands = chosen.select("node", "sketch").mapInArrow(_bands(percent), "bucket long, node long")
    heads = bands.groupBy("bucket").agg(F.min("node").alias("head"), F.count("*").alias("size")).where("size > 1")
    members = kept(bands.join(heads, "bucket"))

    wanted = kept(members.select("node").distinct().join(chosen.select("node", "row_key", "print"), "node"))
    texts = rows.select("row_key", "_text").join(hinted(wanted, 80), "row_key").select("node", "print", "_text")
    made = texts.mapInArrow(_set_maker(n, percent), "node long, n long, keys binary, fine binary, hashes binary")
    # Repeated rows (same id and text) bring a set again. Made in a job of their own, so that a task runs one Python step at a time.
    sets = kept(made.dropDuplicates(["node"]))
    sets.count()

    one = chosen.select("node", "sketch", "n_shingles")
    pairs = (
        members.where("node <> head").select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()
        .join(one.toDF("b", "sketch_b", "n_b"), "b").join(one.toDF("a", "sketch_a", "n_a"), "a")
        .select("a", "b", "sketch_a", "sketch_b", "n_a", "n_b").mapInArrow(_likely(percent), "a long, b long")
    )
    links = written(_verified(written(pairs, "pairs-with-heads"), sets, percent), "links-to-heads")
    label = components(links)
    more = written(_further(members, one, sets, label, percent), "further-links")
    if not more.isEmpty():
        label = components(links.union(more))
    for held in (wanted, members, chosen, sets):
        held.unpersist()
    return _answer(sketches, classes, label).withColumnRenamed("id", id_column)


def _further(members: DataFrame, one: DataFrame, sets: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """A forest of the links between different components in the buckets with three and more classes."""
    spread = (
        members.where("size > 2").join(label, "node", "left").join(one.select("node", "n_shingles"), "node")
        .select("bucket", "node", "head", "n_shingles", F.coalesce("component", "node").alias("component"))
    )
    spread = written(spread, "bucket-components")
    open_buckets = spread.groupBy("bucket").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.max(F.when(F.col("node") == F.col("head"), F.col("component"))).alias("main"),
    ).where("low <> high")
    placed = spread.join(open_buckets.select("bucket", "main"), "bucket").withColumn("inside", F.col("component") == F.col("main"))

    def blocks(inside: Column) -> Column:
        """Blocks of a part of a bucket: as its classes and their shingles ask for."""
        rows, shingles = F.count(F.when(inside, 1)), F.sum(F.when(inside, F.col("n_shingles")).otherwise(0))
        return F.greatest(F.ceil(rows / F.lit(BLOCK)), F.least(rows, F.ceil(shingles / F.lit(BLOCK_SHINGLES)))).cast("int")

    counts = placed.groupBy("bucket").agg(blocks(F.col("inside")).alias("b_inside"), blocks(~F.col("inside")).alias("b_rest"))
    held = placed.join(counts, "bucket")
    block = F.pmod(F.xxhash64("node"), F.when(F.col("inside"), F.col("b_inside")).otherwise(F.col("b_rest"))).cast("int")
    # Cells: a block of the rest against itself, a later block of the rest, or a block of the main component.
    cell = lambda i, kind, j, side, second: F.struct(
        i.cast("int").alias("i"), F.lit(kind).alias("kind"), j.cast("int").alias("j"), F.lit(side).alias("side"), F.lit(second).alias("second")
    )
    up_to = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.col("block")
    rest = F.concat(
        F.array(cell(own, 0, own, 0, 0)),
        F.transform(F.filter(up_to(F.col("b_rest")), lambda k: k > own), lambda k: cell(own, 0, k, 0, 1)),
        F.transform(F.filter(up_to(F.col("b_rest")), lambda k: k < own), lambda k: cell(k, 0, own, 1, 1)),
        F.transform(up_to(F.col("b_inside")), lambda k: cell(own, 1, k, 0, 1)),
    )
    main = F.transform(up_to(F.col("b_rest")), lambda k: cell(k, 1, own, 1, 1))
    cells = (
        held.withColumn("block", block)
        .select("bucket", "node", "component", F.explode(F.when(F.col("inside"), main).otherwise(rest)).alias("cell"))
        .select("bucket", "node", "component", "cell.*")
    )
    filled = cells.join(sets.select("node", "n", "keys", "fine"), "node")
    place = ["bucket", "i", "kind", "j"]
    left_open = written(filled.groupBy(*place).applyInArrow(
        _open_classes(percent), "bucket long, i int, kind int, j int, node long, side int, second int"), "open-classes")
    return left_open.join(sets.select("node", "hashes"), "node").groupBy(*place).applyInArrow(_exact_links(percent), "a long, b long").distinct()


def _answer(sketches: DataFrame, classes: DataFrame, label: DataFrame) -> DataFrame:
    linked = label.join(classes.select("node", "first"), "node")
    lowest = linked.groupBy("component").agg(F.min("first").alias("lowest"))
    found = classes.join(label.join(lowest, "component").select("node", "component", "lowest"), "node", "left").select(
        "print", F.coalesce("component", "node").alias("group"), F.coalesce("lowest", "first").alias("component_id"), F.lit(True).alias("has_words")
    )
    return sketches.drop("sketch", "row").join(found, "print", "left").select(
        "id", "row_key", "n_shingles", "group", F.when(F.col("has_words"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col("id").eqNullSafe(F.col("component_id")))


def first_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns: that with the smallest id, ties broken by ``row_key``.

    Of rows equal in id and text one stays, whatever their other columns: that with the smallest hash of all columns. A row without id stays only if no
    row of its group has one, and then one of them. Columns of the names ``row_key``, ``kept`` and ``n`` must not be there.
    """
    found = near_duplicates(docs, id_column, text, percent)
    rows = written(found.groupBy("row_key").agg(F.min("group").alias("group"), F.min(id_column).alias("id"), F.count("*").alias("n")), "groups")
    first = F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", "row_key"))
    best = rows.where("group is not null").groupBy("group").agg(first.alias("first")).select("first.row_key", F.lit(True).alias("best"))
    keys = written(
        rows.join(best, "row_key", "left").select("row_key", F.expr("group is null or best is not null").alias("kept"), "n")
        .where("not kept or n > 1"), "verdicts"
    )
    again = docs.withColumn("row_key", row_key(id_column, text)).join(hinted(keys, 80), "row_key", "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    one = again.where("kept and n > 1").groupBy("row_key").agg(F.min_by(F.struct(*own), F.xxhash64(F.to_json(F.struct(*own)))).alias("one"))
    return again.where("kept is null").select(*own).union(one.select("one.*"))


def op7_minhash(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
