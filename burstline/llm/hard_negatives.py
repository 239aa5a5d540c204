"""Hard negatives by shared candidate lists of anchor clusters.

Scores are inner products of vectors made integers (``floor(scale * x)``). Anchors are put in clusters by direction. No member of a
cluster can score a candidate higher than its own length times ``length of the candidate * cos(angle to the cluster's centre -
widest angle of a member to the centre)``, so candidates are sorted by that bound once for the whole cluster, and every member walks the
one list until the bound certifies that nothing behind can enter its result.

Candidates are dealt into blocks and anchors into groups of whole clusters; a task holds one block and one group, and walks one list for each
cluster of the group. So a candidate is sent once for each group, never once for an anchor, and a task's best few are merged
with those of other blocks by a top-k aggregate. Two passes: the first finds each anchor's positives, starting from a
floor that a bounded sample of candidates gives; the second the negatives in each positive's score band, whose lower end is its floor.

Clusters and the sample only steer how far a list is walked. The result is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burstline.llm.codes import sound
from burstline.llm.common import bounded_sample, kept, table, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100  # band of a negative's score, in hundredths of the positive's
LARGEST = 1 << 26  # greatest size of a scaled component: products of a thousand of them fit a long
BLOCK = 4_096  # candidates to a block
GROUP = 2_048  # anchors to a group
MEMBERS = 64  # anchors to a cluster, about
MOST_CLUSTERS = 1_024
SAMPLE = 8_192  # anchors that the centres are fitted on
FLOOR_SAMPLE = 1_024  # candidates that give the first floors
STEP = 256  # places of a list walked at once
SLACK = 1e-6  # radians added to angles, against rounding
NO_ID = (1 << 63) - 1  # stands for a missing id, which comes last among ties

ROWS = "dim int, row long, id long, label string, vector binary"


@dataclass
class Found:
    """Best candidates of several lists: order of ``score`` down, then ``id``, then ``row``."""

    score: np.ndarray
    id: np.ndarray
    row: np.ndarray

    @staticmethod
    def empty() -> Found:
        return Found(*(np.zeros(0, np.int64) for _ in range(3)))

    def with_more(self, score: np.ndarray, id_: np.ndarray, row: np.ndarray, most: int) -> Found:
        score, id_, row = (np.concatenate(x) for x in zip((self.score, self.id, self.row), (score, id_, row)))
        best = np.lexsort((row, id_, -score))[:most]
        return Found(score[best], id_[best], row[best])

    def floor(self, most: int, least: float) -> float:
        """A candidate below this score cannot enter; one equal to it may, by its id."""
        return max(least, float(self.score[-1])) if len(self.score) == most else least


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows; by floating point where that holds every sum exactly."""
    largest = max(float(np.abs(a).max(initial=0)), 1.0) * max(float(np.abs(b).max(initial=0)), 1.0) * a.shape[1]
    if largest < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for a zero vector) and lengths."""
    length = np.linalg.norm(vectors.astype(np.float64), axis=1)
    return vectors / np.maximum(length, 1e-300)[:, None], length


def centres(sample: np.ndarray, clusters: int, turns: int = 8, seed: int = 7) -> np.ndarray:
    """Spherical k-means on the directions of the sample."""
    unit, _ = directions(sample)
    book = unit[np.random.default_rng(seed).permutation(len(unit))[:clusters]].copy()
    for _ in range(turns):
        near = (unit @ book.T).argmax(axis=1)
        sums = np.zeros_like(book)
        np.add.at(sums, near, unit)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        book = np.where(size > 1e-12, sums / np.maximum(size, 1e-300), book)
    return book


def _angles(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centre, -1, 1))


def shared_list(members: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the candidates by falling bound, and the bounds: times a member's length, no score of it is higher."""
    unit, _ = directions(members)
    centre = unit.sum(axis=0)
    size = np.linalg.norm(centre)
    other, length = directions(candidates)
    if size < 1e-9:
        bound = length
    else:
        centre = centre / size
        widest = _angles(unit, centre).max() + 2 * SLACK
        bound = length * np.cos(np.maximum(0, _angles(other, centre) - widest))
    bound = bound + length * SLACK
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


def walk(members: np.ndarray, candidates: np.ndarray, floors: Callable[[int], float], take: Callable[[int, np.ndarray, np.ndarray], None]) -> int:
    """Each member walks the cluster's list until its floor certifies the rest; returns how many products were formed.

    ``take(member, places, scores)`` is given what is met; ``floors(member)`` the score below which nothing is of use.
    """
    order, bound = shared_list(members, candidates)
    _, length = directions(members)
    active, formed = np.arange(len(members)), 0
    for low in range(0, len(order), STEP):
        reach = length[active] * bound[low] + SLACK
        active = active[[reach[k] >= floors(m) for k, m in enumerate(active.tolist())]]
        if not len(active):
            break
        places = order[low : low + STEP]
        scores = products(members[active], candidates[places])
        formed += scores.size
        for k, m in enumerate(active.tolist()):
            take(m, places, scores[k])
    return formed


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), dtype="<i4").reshape(len(rows), -1).astype(np.int64)


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).combine_chunks().to_numpy(zero_copy_only=False)


def _clusters(anchors: pa.Table) -> Iterator[np.ndarray]:
    cluster = _column(anchors, "cluster")
    order = np.argsort(cluster, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1)


def _positives(most: int):
    """The best rows of the anchor's label in one block, for each anchor of one group."""

    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and block.num_rows:
            mine, theirs = _vectors(anchors.column("vector")), _vectors(block.column("vector"))
            row, label, least = _column(anchors, "row"), _column(anchors, "label"), _column(anchors, "floor")
            ids, rows, labels = _column(block, "id"), _column(block, "row"), _column(block, "label")
            for members in _clusters(anchors):
                best = [Found.empty() for _ in members]

                def take(m: int, places: np.ndarray, scores: np.ndarray) -> None:
                    a = members[m]  # noqa: B023
                    fit = (labels[places] == label[a]) & (rows[places] != row[a]) & (scores >= best[m].floor(most, least[a]))  # noqa: B023
                    if fit.any():
                        best[m] = best[m].with_more(scores[fit], ids[places[fit]], rows[places[fit]], most)  # noqa: B023

                walk(mine[members], theirs, lambda m: best[m].floor(most, least[members[m]]), take)  # noqa: B023
                for m, found in enumerate(best):
                    out += [(int(row[members[m]]), *x) for x in zip(found.score.tolist(), found.id.tolist(), found.row.tolist())]
        names = ["anchor", "score", "id", "row"]
        return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(names)})

    return run


def _negatives(most: int, low: int, high: int):
    """The best rows of other labels in the score band of each positive, in one block, for each anchor of one group."""

    def run(anchors: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if anchors.num_rows and block.num_rows:
            mine, theirs = _vectors(anchors.column("vector")), _vectors(block.column("vector"))
            row, label = _column(anchors, "row"), _column(anchors, "label")
            wanted = anchors.column("positives").to_pylist()
            ids, rows, labels = _column(block, "id"), _column(block, "row"), _column(block, "label")
            for members in _clusters(anchors):
                # Bounds of each band, rounded to the integers inside it; positives of one score share a list.
                bands = [{p: (-(-low * p // 100), high * p // 100) for p in wanted[a]} for a in members]
                best = [{p: Found.empty() for p, (least, top) in some.items() if least <= top} for some in bands]

                def floor(m: int) -> float:
                    return min((f.floor(most, bands[m][p][0]) for p, f in best[m].items()), default=np.inf)  # noqa: B023

                def take(m: int, places: np.ndarray, scores: np.ndarray) -> None:
                    other = (labels[places] != label[members[m]]) & (scores >= floor(m))  # noqa: B023
                    if not other.any():
                        return
                    places, scores = places[other], scores[other]
                    for p, found in best[m].items():  # noqa: B023
                        fit = (scores <= bands[m][p][1]) & (scores >= found.floor(most, bands[m][p][0]))  # noqa: B023
                        if fit.any():
                            best[m][p] = found.with_more(scores[fit], ids[places[fit]], rows[places[fit]], most)  # noqa: B023

                walk(mine[members], theirs, floor, take)
                for m, some in enumerate(best):
                    out += [(int(row[members[m]]), p, *x) for p, f in some.items() for x in zip(f.score.tolist(), f.id.tolist(), f.row.tolist())]
        names = ["anchor", "positive_score", "score", "id", "row"]
        return pa.table({n: pa.array([x[i] for x in out], pa.int64()) for i, n in enumerate(names)})

    return run


def _integers(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(batch.column("dim").to_numpy())
            whole = np.floor(flat * scale).astype("<i4")
            packed = [part.tobytes() for part in np.split(whole, ends[:-1])]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("dim", "id", "label")), pa.array(packed, pa.binary())], names=["dim", "id", "label", "vector"])

    return run


def _clustered(model, most: int):
    """Each anchor with its cluster and the score that ``most`` others of its label in the sample reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, vectors, labels, rows = model.value
        for batch in batches:
            if not batch.num_rows:
                continue
            mine = _vectors(batch.column("vector"))
            scores = products(mine, vectors)
            own, me = np.array(batch.column("label").to_pylist(), dtype=object), batch.column("row").to_numpy()
            other = (labels[None] == own[:, None]) & (rows[None] != me[:, None])
            enough = other.sum(axis=1) >= most
            floor = np.full(len(mine), -np.inf)
            if enough.any():
                ranked = np.sort(np.where(other, scores.astype(np.float64), -np.inf), axis=1)
                # Rounded down, as a long may be more than a double tells apart.
                floor[enough] = np.nextafter(ranked[enough, -most], -np.inf)
            near = (directions(mine)[0] @ book.T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.int64()), pa.array(floor, pa.float64())], names=[*batch.schema.names, "cluster", "floor"])

    return run


def _grouped(anchors: DataFrame, group: int, members: int) -> DataFrame:
    """Anchors with a ``group`` of about so many: whole clusters side by side, a large cluster in several groups."""
    sizes = anchors.groupBy("cluster").agg(F.count("*").alias("n"))  # MOST_CLUSTERS rows at most
    listed = sorted((r["cluster"], r["n"]) for r in sizes.collect())
    groups, first, room = [], 0, group
    for cluster, n in listed:
        parts = -(-n // group)
        if parts > 1 or n > room:
            first, room = first + (room < group), group
        groups.append((cluster, first, parts))
        if parts > 1:
            first += parts
        else:
            room -= n
    dealt = F.broadcast(anchors.sparkSession.createDataFrame(groups, "cluster long, first int, parts int"))
    return anchors.join(dealt, "cluster").withColumn("group", F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts")).cast("int")).drop("first", "parts")


def _ranked(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best ``most`` rows for each key in order, as ``best``: formed part by part, so no key's rows meet in one task unmerged."""
    entry = F.struct((-F.col("score")).alias("down"), "id", "row")
    # Every task has sent its best few only: at most ``most`` rows a block.
    return rows.groupBy(*keys, F.pmod(F.xxhash64("row"), F.lit(64)).alias("_part")).agg(F.slice(F.array_sort(F.collect_list(entry)), 1, most).alias("_some")).groupBy(
        *keys).agg(F.slice(F.array_sort(F.flatten(F.collect_list("_some"))), 1, most).alias("best"))


def hard_negatives(rows: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = SCALE,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: a row for each negative found.

    ``is_anchor`` is a condition on the id, as column ``id``. An anchor's positives are the first ``positives`` other rows of its label, by
    score from the highest, ties by id; a positive's negatives the first ``negatives`` rows of other labels with ``low`` to ``high`` hundredths
    of its score. Fewer are given where there are fewer; a band above and below nothing (a positive scored below 0) has none.

    Rows whose label or vector is null, whose vector is empty or holds a null, a component that is not finite or is over LARGEST once
    scaled, take no part. Rows meet rows of their own vector length only. A zero vector scores 0 with all. Repeated ids are rows of their own, also as
    anchors; a row without id comes last among ties and is no anchor. Other columns play no part; no rows give no rows.
    """
    named = rows.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"), F.col(f"`{vector}`").alias("vector"))
    able = named.where(F.col("label").isNotNull() & sound(F.col("vector"), LARGEST / scale) & (F.size("vector") > 0))
    able = able.select(F.size("vector").alias("dim"), F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "vector")
    whole = written(able.mapInArrow(_integers(scale), "dim int, id long, label string, vector binary").withColumn("row", F.monotonically_increasing_id()), "candidates")
    whole = whole.select("dim", "row", "id", "label", "vector")
    found = None
    for size in sorted(whole.groupBy("dim").agg(F.count("*").alias("n")).collect()):  # one row per vector length
        part = _mined(whole.where(F.col("dim") == size["dim"]), size["n"], is_anchor, positives, negatives, low, high)
        if part is not None:
            found = part if found is None else found.union(part)
    if found is None:
        found = rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return found.select("anchor_id", known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def _mined(whole: DataFrame, count: int, is_anchor: Column, positives: int, negatives: int, low: int, high: int) -> DataFrame | None:
    spark = whole.sparkSession
    asked = whole.where(is_anchor & (F.col("id") != NO_ID))
    n = asked.count()
    if not n:
        return None
    clusters = max(1, min(MOST_CLUSTERS, n // MEMBERS))
    fitted = _vectors(bounded_sample(asked, F.col("row"), SAMPLE).orderBy("row").select("vector").toArrow().column("vector"))
    if not len(fitted):
        fitted = _vectors(asked.limit(1).select("vector").toArrow().column("vector"))
    some = bounded_sample(whole, F.col("row"), FLOOR_SAMPLE).orderBy("row").toArrow()
    some_labels = np.array(some.column("label").to_pylist(), dtype=object)
    some_vectors = _vectors(some.column("vector")) if some.num_rows else np.zeros((0, fitted.shape[1]), np.int64)
    model = spark.sparkContext.broadcast((centres(fitted, clusters), some_vectors, some_labels, some.column("row").to_numpy()))
    anchors = written(_grouped(asked.mapInArrow(_clustered(model, positives), f"{ROWS}, cluster long, floor double"), GROUP, MEMBERS), "anchors")

    groups = anchors.agg(F.max("group").alias("n")).first()["n"] + 1
    blocks = -(-count // BLOCK)
    # A grid of blocks and groups: a row goes to each cell of its block, an anchor to each of its group.
    block = F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")
    cells = whole.select("id", "row", "label", "vector", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")

    def searched(asking: DataFrame, work, schema: str) -> DataFrame:
        sent = asking.select("*", every)
        return sent.groupBy("block", "group").cogroup(cells.groupBy("block", "group")).applyInArrow(work, schema)

    first = searched(anchors.select("row", "label", "vector", "cluster", "group", "floor"), _positives(positives), "anchor long, score long, id long, row long")
    best = kept(_ranked(first, ["anchor"], positives))
    scored = anchors.join(best.select(F.col("anchor").alias("row"), F.expr("array_distinct(transform(best, x -> -x.down))").alias("positives")), "row")
    second = searched(scored.select("row", "label", "vector", "cluster", "group", "positives"), _negatives(negatives, low, high),
                      "anchor long, positive_score long, score long, id long, row long")
    lists = _ranked(second, ["anchor", "positive_score"], negatives)
    pairs = best.select("anchor", F.explode("best").alias("p")).select("anchor", F.col("p.id").alias("positive_id"), (-F.col("p.down")).alias("positive_score"))
    named = pairs.join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return named.join(lists, ["anchor", "positive_score"]).select("anchor_id", "positive_id", "positive_score", F.posexplode("best").alias("at", "found")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("found.id").alias("negative_id"), "positive_score", (-F.col("found.down")).alias("negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    changed = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(changed, F.col("id") % 100 == 0)
