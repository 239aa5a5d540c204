"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in halves; each half has its own codebook, fitted on a bounded sample, and every vector is
indexed under the cell (nearest code of the first half, nearest of the second). A query visits the cells of this product grid
in the order of the summed squared distances (the multi-sequence order). How many it visits is measured:
two bounded sets of queries, one drawn from all vectors and one dealt evenly over the cells, are compared with all rows. The smallest
number of cells is taken that holds the target share of a query's true links, on the mean over the queries of either set that have
links: a query of a dense group counts no more than one with a single link. Where too few of those dealt over the cells have any, made
neighbours at the least cosine, in random directions, stand in for the missing. Vectors met in a visited cell are verified by cosine in double precision.

Equal vectors of a label are one node. Large cells are cut in blocks, compared block against block; a block
comparison gives, for each node it links, the links it found and one node that stands for its component there, never
the pairs. So rows grow with the nodes, also where a third of all vectors are close to each other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burstline.llm.common import bounded_sample, kept, table, written
from burstline.llm.components import components

LEAST = 0.93
RECALL = 0.999
SAMPLE = 20_000  # vectors the codebooks are fitted on
QUERIES = 1_024  # vectors of either set whose true links decide how many cells are visited
ENOUGH = 256  # queries with links, of those dealt over the cells; made neighbours stand in for fewer
MADE = 8  # neighbours made for a query
LEVELS = 16  # ranks of cells are told apart up to 1/16 of an octave, rounded up
FEWEST_CELLS = 8
CELL_ROWS = 32  # vectors of a label in a cell, about: sets the size of the codebooks
MOST_CODES = 256
BLOCK = 2_048


def unit(batch: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, scaled to length one, in double precision."""
    flat = batch.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    # Scaled twice: squares of very large or small numbers stay finite.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


class MultiIndex:
    """Two codebooks and the order in which a vector visits the cells of their product."""

    def __init__(self, sample: np.ndarray, codes: int, turns: int = 12, seed: int = 5):
        self.half = max(1, sample.shape[1] // 2)
        self.books = [self._fit(part, codes, turns, seed) for part in (sample[:, : self.half], sample[:, self.half :])]
        self.width = len(self.books[1])
        self.cells = len(self.books[0]) * self.width

    @staticmethod
    def _fit(points: np.ndarray, codes: int, turns: int, seed: int) -> np.ndarray:
        some = np.random.default_rng(seed).permutation(len(points))[:codes]
        book = points[some].copy()
        for _ in range(turns):
            near = _distances(points, book).argmin(axis=1)
            sums = np.zeros_like(book)
            np.add.at(sums, near, points)
            count = np.bincount(near, minlength=len(book))[:, None]
            book = np.where(count > 0, sums / np.maximum(count, 1), book)
        return book

    def visits(self, vectors: np.ndarray, most: int) -> np.ndarray:
        """The first ``most`` cells of each vector, nearest first; ties by the order of the codes."""
        first, second = _distances(vectors[:, : self.half], self.books[0]), _distances(vectors[:, self.half :], self.books[1])
        by_first, by_second = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        # Cell (i, j) by ranks comes after all (i+1)*(j+1)-1 cells that are no farther in either half.
        i, j = np.indices((first.shape[1], second.shape[1]))
        able = ((i + 1) * (j + 1) <= most).reshape(-1)
        i, j = i.reshape(-1)[able], j.reshape(-1)[able]
        total = np.take_along_axis(first, by_first, 1)[:, i] + np.take_along_axis(second, by_second, 1)[:, j]
        order = np.argsort(total, axis=1, kind="stable")[:, :most]
        cells = by_first[:, i] * self.width + by_second[:, j]
        return np.take_along_axis(cells, order, 1)


def _distances(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.maximum((points**2).sum(1)[:, None] - 2 * points @ book.T + (book**2).sum(1)[None], 0)


def _level(rank: np.ndarray) -> np.ndarray:
    """The number of the first level that holds a rank (from 0)."""
    return np.ceil(np.log2(rank + 1.0) * LEVELS - 1e-9).astype(np.int64)


def _cells_of(level: int) -> int:
    """How many cells are visited up to the end of a level."""
    return int(np.floor(2 ** (level / LEVELS) + 1e-6))


def _rank_of(at: MultiIndex, vectors: np.ndarray, cells: list[np.ndarray]) -> list[np.ndarray]:
    """The place of each of the cells in the order in which each vector visits all."""
    out = []
    for k, asked in enumerate(cells):
        rank = np.empty(at.cells, dtype=np.int64)
        rank[at.visits(vectors[k : k + 1], at.cells)[0]] = np.arange(at.cells)
        out.append(rank[asked])
    return out


def _ranks(index, queries, dim: int, least: float):
    """Counts of true links of each query by the level of the rank at which it visits the linked row's cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, labels, asked = queries.value
        at = index.value
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for batch in batches:
            rows = unit(batch.column("vector"), dim)
            if not len(rows):
                continue
            label, node = batch.column("label").to_numpy(), batch.column("node").to_numpy()
            for low in range(0, len(rows), 1024):
                part = slice(low, low + 1024)
                near = (asked @ rows[part].T >= least) & (labels[:, None] == label[part][None]) & (nodes[:, None] != node[part][None])
                q, r = np.nonzero(near)
                if not len(q):
                    continue
                cell = at.visits(rows[part], 1)[:, 0]
                new, n = np.unique(q * at.cells + cell[r], return_counts=True)
                keys, back = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(back, weights=np.concatenate([counts, n]), minlength=len(keys)).astype(np.int64)
        q, cell = keys // at.cells, keys % at.cells
        some, starts = np.unique(q, return_index=True)
        level = [_level(x) for x in _rank_of(at, asked[some], np.split(cell, starts[1:]) if len(some) else [])]
        level = np.concatenate([np.zeros(0, dtype=np.int64), *level])
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(level), pa.array(counts)], names=["query", "level", "links"])

    return run


def _made_levels(at: MultiIndex, vectors: np.ndarray, least: float) -> np.ndarray:
    """For each vector a row of counts by level: of neighbours at the cosine ``least``, in random directions."""
    away = np.random.default_rng(2).normal(size=(len(vectors), MADE, vectors.shape[1]))
    away -= (away @ vectors[:, :, None]) * vectors[:, None]
    length = np.linalg.norm(away, axis=2, keepdims=True)
    away = np.divide(away, length, out=np.zeros_like(away), where=length > 1e-9)  # no direction is free in one dimension
    made = least * vectors[:, None] + (1 - least**2) ** 0.5 * away
    cells = [at.visits(x, 1)[:, 0] for x in made]
    out = np.zeros((len(vectors), int(_level(np.array(at.cells - 1))) + 1))
    for row, rank in zip(out, _rank_of(at, vectors, cells)):
        np.add.at(row, _level(rank), 1)
    return out


def _enough(levels: np.ndarray, recall: float) -> int:
    """The fewest cells that hold the share ``recall`` of a row's links on the mean over the rows (counts by level) that have any."""
    levels = levels[levels.sum(1) > 0]
    if not len(levels):
        return 0
    reached = (levels.cumsum(1) / levels.sum(1, keepdims=True)).mean(0)
    return _cells_of(int(np.argmax(reached >= recall)))


def _placed(index, dim: int, most: int):
    """Each vector as data (side 0) in its own cell and as query (side 1) in the other cells it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2048):
                rows = batch.slice(low, 2048)
                cells = index.value.visits(unit(rows.column("vector"), dim), most)
                count, each = cells.shape
                side = np.tile((np.arange(each) > 0).astype(np.int32), count)
                yield pa.RecordBatch.from_arrays([
                    rows.column("label").take(pa.array(np.repeat(np.arange(count), each))), pa.array(cells.reshape(-1), pa.int64()), pa.array(side),
                    rows.column("node").take(pa.array(np.repeat(np.arange(count), each))),
                ], names=["label", "cell", "side", "node"])

    return run


def _block_links(index, dim: int, most: int, least: float):
    """For each linked node of one cell block pair: its links there (copies counted) and its component's first node."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        node, side, copies = (rows.column(c).to_numpy() for c in ("node", "side", "copies"))
        vector = unit(rows.column("vector").combine_chunks(), dim)
        data, asked = np.flatnonzero(side == 0), np.flatnonzero(side > 0)
        cell = rows.column("cell")[0].as_py()
        empty = pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        if not len(data) or not len(asked):
            return empty
        inner = side[asked] == 2  # data of the same cell, in the part of a query
        own = index.value.visits(vector[asked], 1)[:, 0]
        # Vectors of two cells that visit each other meet twice: the smaller cell of the two counts them.
        seen = index.value.visits(vector[data], most)
        seen = np.sort((np.arange(len(data))[:, None] * index.value.cells + seen).reshape(-1))
        links, root = np.zeros(len(node), dtype=np.int64), node.copy()
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for low in range(0, len(asked), 512):
            part = slice(low, low + 512)
            near = vector[asked[part]] @ vector[data].T >= least
            if not near.any():
                continue
            q, d = np.nonzero(near)
            same = inner[part][q]
            visit = d * index.value.cells + own[part][q]
            met = seen[np.minimum(np.searchsorted(seen, visit), len(seen) - 1)] == visit
            q_node, d_node = node[asked[part]][q], node[data][d]
            keep = np.where(same, q_node < d_node, ~(met & (own[part][q] < cell)))
            q, d = asked[part][q[keep]], data[d[keep]]
            np.add.at(links, q, copies[d])
            np.add.at(links, d, copies[q])
            if len(q):
                # A forest is enough: what one slice connects is passed on as node and root.
                found.append(_forest(q, d, node))
        if not found:
            return empty
        a, b = (np.concatenate(x) for x in zip(*found))
        a, b = _forest(a, b, node)
        lowest = dict(zip(node[a].tolist(), node[b].tolist()))
        # The same vector may stand on both sides of a block pair: its rows are added up later.
        some = np.flatnonzero(links)
        root = [lowest.get(x, x) for x in node[some].tolist()]
        return pa.table({"node": pa.array(node[some], pa.int64()), "links": pa.array(links[some], pa.int64()), "root": pa.array(root, pa.int64())})

    return run


def _forest(a: np.ndarray, b: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every end of the links a-b with the place whose node is the smallest of its component."""
    places, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    # The two places of one node are one.
    _, same = np.unique(node[places], return_inverse=True)
    x, y = same[x], same[y]
    label = np.arange(same.max() + 1)
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, x, low)
        np.minimum.at(new, y, low)
        np.minimum.at(new, label[x], low)
        np.minimum.at(new, label[y], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    first = np.zeros(len(label), dtype=np.int64)
    first[same[::-1]] = places[::-1]
    return places, first[label[same]]


def near_vectors(rows: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", least: float = LEAST, recall: float = RECALL) -> DataFrame:
    """One row per row: the id, ``n_links``, ``component_id`` and ``kept``.

    Two vectors are linked if their labels are equal and not null, their lengths equal, and their cosine at least
    ``least``. Vectors that are null, empty, all zero, or hold a null or a number that is not finite link with nothing, and neither do
    vectors without label. ``component_id`` is the smallest id reachable, the own one included; ``kept`` whether it is the
    own. Rows that repeat an id are vectors of their own; a row without id is never the smallest.
    """
    named = rows.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{label}`").alias("label_"), F.col(f"`{vector}`").alias("vector"))
    sound = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("vector", lambda v: v != 0)
    named = named.withColumn("able", F.coalesce(F.col("label_").isNotNull() & sound, F.lit(False))).withColumn("hash", F.xxhash64("vector"))
    keys = ["label_", "hash", "vector"]
    nodes = named.where("able").groupBy(*keys).agg(F.count("*").alias("copies"), F.min("id").alias("first"))
    # A label becomes a number by the order of the nodes table; the vectors are written once.
    nodes = written(nodes.withColumns({"node": F.monotonically_increasing_id(), "label": F.xxhash64("label_"), "dim": F.size("vector")}), "vectors")

    found = None
    for dim in sorted(r["dim"] for r in nodes.select("dim").distinct().collect()):
        part = _search(nodes.where(F.col("dim") == dim).select("label", "node", "copies", "vector"), dim, least, recall)
        found = part if found is None else found.union(part)
    if found is None:
        alone = F.col("id").alias("component_id")
        return named.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"), alone, F.lit(True).alias("kept"))
    found = kept(found)
    parts = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    lowest = parts.join(nodes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("lowest"))
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.select("node", *keys, "copies", "first")
        .join(counted, "node", "left").join(parts.join(lowest, "component").select("node", "lowest"), "node", "left")
        .select(*keys, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("lowest", "first").alias("lowest"))
        .withColumn("able", F.lit(True))
    )
    return named.join(known, ["able", *keys], "left").select(
        F.col("id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNotNull(), F.col("lowest")).otherwise(F.col("id")).alias("component_id"),
    ).withColumn("kept", F.col(id_column).eqNullSafe(F.col("component_id")))


def _query_sets(at: MultiIndex, sample: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sample of the queries drawn from all, and of those dealt over the cells of the labels: one of each before a second of any."""
    order = np.random.default_rng(1).permutation(len(sample))
    cell = np.concatenate([at.visits(sample[order[low : low + 2048]], 1)[:, 0] for low in range(0, len(order), 2048)])
    _, group = np.unique(np.stack([label[order], cell]), axis=1, return_inverse=True)
    by_group = np.argsort(group.reshape(-1), kind="stable")
    sizes = np.bincount(group.reshape(-1))
    turn = np.empty(len(order), dtype=np.int64)
    turn[by_group] = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[:QUERIES], order[np.argsort(turn, kind="stable")[:QUERIES]]


def fitted_index(nodes: DataFrame, dim: int, least: float, recall: float):
    """The broadcast index and the number of cells to visit; both from bounded samples, chosen by hash."""
    spark = nodes.sparkSession
    size = nodes.agg(F.count("*").alias("n"), F.countDistinct("label").alias("labels")).first()
    codes = int(min(MOST_CODES, max(2, round((size["n"] / size["labels"] / CELL_ROWS) ** 0.5))))
    picked = bounded_sample(nodes, F.col("node"), SAMPLE).orderBy("node").toArrow()
    sample = unit(picked.column("vector").combine_chunks(), dim)
    index = spark.sparkContext.broadcast(MultiIndex(sample, codes))
    node, label = picked.column("node").to_numpy(), picked.column("label").to_numpy()
    drawn, dealt = _query_sets(index.value, sample, label)
    some = np.union1d(drawn, dealt)
    queries = spark.sparkContext.broadcast((node[some], label[some], sample[some]))
    found = (
        nodes.select("label", "node", "vector").mapInArrow(_ranks(index, queries, dim, least), "query long, level long, links long")
        .groupBy("query", "level").agg(F.sum("links").alias("links")).toArrow()  # 2 * QUERIES times the levels at most
    )
    levels = np.zeros((len(some), int(_level(np.array(index.value.cells - 1))) + 1))
    levels[found.column("query").to_numpy(), found.column("level").to_numpy()] = found.column("links").to_numpy()
    drawn, dealt = levels[np.isin(some, drawn)], dealt[np.argsort(dealt)]
    own = levels[np.isin(some, dealt)]
    alone = np.flatnonzero(own.sum(1) == 0)
    missing = max(0, ENOUGH - (len(own) - len(alone)))
    if missing and len(own) < len(node):
        stand_in = dealt[(alone if len(alone) else np.arange(len(own)))[:missing]]
        own = np.concatenate([own, _made_levels(index.value, sample[stand_in], least)])
    return index, min(index.value.cells, max(FEWEST_CELLS, _enough(drawn, recall), _enough(own, recall)))


def _search(nodes: DataFrame, dim: int, least: float, recall: float) -> DataFrame:
    index, most = fitted_index(nodes, dim, least, recall)
    placed = kept(nodes.select("label", "node", "vector").mapInArrow(_placed(index, dim, most), "label long, cell long, side int, node long"))
    sizes = placed.groupBy("label", "cell").agg(
        F.count(F.when(F.col("side") == 0, 1)).alias("n_data"), F.count("*").alias("n_asked")
    ).where("n_data > 0")
    blocks = lambda c: F.ceil(F.col(c) / F.lit(BLOCK)).cast("int")
    held = placed.join(sizes.select("label", "cell", blocks("n_data").alias("d"), blocks("n_asked").alias("q")), ["label", "cell"])
    # Data is compared with the queries of its cell and, as side 2, with the other data of the cell.
    every = lambda n: F.sequence(F.lit(0), n - 1)
    as_data = F.transform(every(F.col("q")), lambda k: F.struct(
        F.pmod(F.xxhash64("node"), F.col("d")).cast("int").alias("i"), k.alias("j"), F.lit(0).alias("side")))
    as_query = F.transform(every(F.col("d")), lambda k: F.struct(
        k.alias("i"), F.pmod(F.xxhash64("node"), F.col("q")).cast("int").alias("j"), F.when(F.col("side") == 0, 2).otherwise(1).alias("side")))
    cells = held.select("label", "cell", "node", F.explode(F.when(F.col("side") == 0, F.concat(as_data, as_query)).otherwise(as_query)).alias("at"))
    filled = cells.select("label", "cell", "node", "at.*").join(nodes.select("node", "copies", "vector"), "node")
    return filled.groupBy("label", "cell", "i", "j").applyInArrow(_block_links(index, dim, most, least), "node long, links long, root long")


def op10_multi_index(spark, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
