"""Hard negatives of anchors by slots between the positives' upper limits.

A window of scores lies below each positive of an anchor. The windows overlap, but their upper limits cut the scores into
disjoint slots: a score is in the slot of the least limit that it does not exceed. Tasks score blocks of anchors against
blocks of vectors and keep the ``k`` best per anchor and slot; those are merged per slot over all tasks. From the lowest
slot upwards, the best of a slot and of all below it are the best up to that slot's limit; each window takes them down
to its own lower limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import merge

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changeflow.llm.topk import exact
from changeflow.session import materialise

#: Vectors of a block of anchors and of a block of candidates.
ANCHORS = 512
CANDIDATES = 1024

LOWEST = -np.iinfo(np.int64).max


class Kept:
    """The best ``k`` (score, smaller id, smaller row first) of each cell so far."""

    def __init__(self, cells: int, k: int) -> None:
        self.k = k
        self.score = np.full((cells, k), LOWEST)
        self.id = np.zeros((cells, k), np.int64)
        self.row = np.full((cells, k), -1)

    def least(self) -> np.ndarray:
        """What is below this score cannot be among the best of the cell."""
        return self.score[:, -1]

    def offer(self, cell: np.ndarray, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        cells = np.unique(cell)
        old = np.nonzero(self.row[cells] >= 0)
        held = (cells[old[0]], *(a[cells][old] for a in (self.score, self.id, self.row)))
        cell, score, ids, rows = (np.concatenate(c) for c in zip((cell, score, ids, rows), held, strict=True))
        order = np.lexsort((rows, ids, -score, cell))
        cell = cell[order]
        rank = np.arange(len(cell)) - np.searchsorted(cell, cell)
        best = order[rank < self.k]
        at = cell[rank < self.k], rank[rank < self.k]
        self.score[at], self.id[at], self.row[at] = score[best], ids[best], rows[best]

    def rows(self) -> tuple[np.ndarray, ...]:
        cell, place = np.nonzero(self.row >= 0)
        return cell, self.id[cell, place], self.row[cell, place], self.score[cell, place]


BLOCK = "dims int, ids binary, rows binary, labels binary, limits binary, columns binary"


def blocks(vectors: DataFrame, size: int, purpose: str) -> DataFrame:
    """Pack ``dims, row, vec_id, label, limits, values`` into blocks of at most ``size`` rows, values a dimension after the other."""
    names = [c.split()[0] for c in BLOCK.split(", ")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dims: int) -> pa.RecordBatch:
            ids, rows, labels, limits, values = zip(*held.pop(dims), strict=True)
            made = [np.array(x, np.int64).tobytes() for x in (ids, rows, labels, limits)]
            made.append(np.ascontiguousarray(np.array(values, np.int64).reshape(len(ids), dims).T).tobytes())
            return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), *(pa.array([x], pa.binary()) for x in made)], names=names)

        for batch in batches:
            for dims, *row in zip(*(batch[c].to_pylist() for c in ("dims", "vec_id", "row", "label", "limits", "values")), strict=True):
                held.setdefault(dims, []).append(tuple(row))
                if len(held[dims]) == size:
                    yield block(dims)
        for dims in list(held):
            yield block(dims)

    read = vectors.select("dims", "vec_id", "row", "label", "limits", "values")
    return materialise(read.mapInArrow(pack, BLOCK), purpose)


def slots_of(scores: np.ndarray, uppers: np.ndarray) -> np.ndarray:
    """For each anchor's ``scores`` the slot, by its descending ``uppers``: -1 above all of them."""
    slot = np.full(scores.shape, -1, np.int8)
    for i in range(uppers.shape[1]):
        slot += scores <= uppers[:, i : i + 1]
    return slot


SCORED = "anchor long, slot int, vec_id long, row long, score long"


def scored(anchors: DataFrame, offered: DataFrame, slots: int, k: int, same_label: bool) -> DataFrame:
    """``anchor, slot, vec_id, row, score``: the ``k`` best of each anchor row and slot among rows of its label, other
    than itself, or of the other labels. ``limits`` of an anchor are its slots' descending upper limits and the least
    score that counts; they come with its block.

    Every block of anchors meets every group of candidate blocks in a task, which holds one block of each.
    """
    parts = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = anchors.withColumn("block", F.monotonically_increasing_id())
    offered = offered.withColumn("part", F.pmod(F.xxhash64("rows"), F.lit(parts)).cast("int"))
    held = ("ids", "rows", "labels", "limits", "columns")
    left = asked.select("dims", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), *held)
    right = offered.join(asked.select("dims", "block"), "dims").select("dims", "block", "part", F.lit(1).alias("kind"), *held)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, asking, kept = None, None, None
        names = [c.split()[0] for c in SCORED.split(", ")]

        def found() -> Iterator[pa.RecordBatch]:
            if kept is not None:
                cell, ids, rows, score = kept.rows()
                columns = [asking["rows"][cell // slots], (cell % slots).astype(np.int32), ids, rows, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                block = {c: np.frombuffer(row[c], np.int64) for c in held}
                block["columns"] = block["columns"].reshape(row["dims"], len(block["ids"]))
                if row["kind"] == 0:
                    yield from found()
                    block["limits"] = block["limits"].reshape(len(block["ids"]), slots + 1)
                    key, asking, kept = (row["block"], row["part"]), block, Kept(len(block["ids"]) * slots, k)
                elif key == (row["block"], row["part"]):
                    meet(asking, block, kept, slots, same_label)
        yield from found()

    met = left.unionByName(right).repartition("block", "part").sortWithinPartitions("block", "part", "kind", F.xxhash64("rows"))
    return met.select("dims", "block", "part", "kind", *held).mapInArrow(search, SCORED)


def meet(asking: dict, block: dict, kept: Kept, slots: int, same_label: bool) -> None:
    """Offer to ``kept`` what the block has for each anchor's slots; the first columns alone, so that thresholds rise early."""
    both = exact(np.concatenate([asking["columns"], block["columns"]], 1))
    n = len(asking["ids"])
    uppers, least = asking["limits"][:, :slots], asking["limits"][:, slots:]
    for a, b in ((0, 64), (64, 256), (256, len(block["ids"]))):
        of = slice(a, min(b, len(block["ids"])))
        scores = (both[:, :n].T @ both[:, n:][:, of]).astype(np.int64)
        slot = slots_of(scores, uppers)
        same = asking["labels"][:, None] == block["labels"][None, of]
        open_ = (slot >= 0) & (scores >= least)
        open_ &= same & (asking["rows"][:, None] != block["rows"][None, of]) if same_label else ~same
        open_ &= scores >= np.take_along_axis(kept.least().reshape(n, slots), np.maximum(slot, 0).astype(np.int64), 1)
        anchor, place = np.nonzero(open_)
        if len(anchor):
            at = place + of.start
            kept.offer(anchor * slots + slot[anchor, place], scores[anchor, place], block["ids"][at], block["rows"][at])


def best_of(lists: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return lists.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def suffix_merged(windows: list[dict], held: list[dict], slots: int, k: int) -> Iterator[tuple[dict, list[tuple]]]:
    """Each window with its rows ``(-score, vec_id, row)``. Windows stand by descending upper limit, one to a slot."""
    per_slot: list[list[tuple]] = [[] for _ in range(slots)]
    for x in held:
        per_slot[x["slot"]].append((-x["score"], x["vec_id"], x["row"]))
    below: list[tuple] = []
    for slot in range(slots - 1, -1, -1):
        below = [x for x, _ in zip(merge(sorted(per_slot[slot]), below), range(k), strict=False)]
        if slot < len(windows):
            yield windows[slot], [x for x in below if -x[0] >= windows[slot]["lower"]]


def mined(vectors: DataFrame, is_anchor: str, positives: int = 5, k: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the anchors of ``vectors``
    (``vec_id, embedding, label``), rows that the SQL condition ``is_anchor`` holds for.

    Components become ``floor(256 * x)`` and scores are integer inner products; higher ones come first, ties by smaller
    ``vec_id``. Positives are an anchor's best other rows of its label. A positive's negatives are the best ``k`` rows of
    other labels whose score is from ``low`` to ``high`` per cent of the positive's, so there are none for a negative
    score. Rows with a null ``vec_id`` or label, a null vector or a null or non-finite component take no part; vectors
    meet only others of their length. A repeated row is an anchor, a positive or a negative of its own. Other columns are not
    read. An empty table gives no rows.
    """
    whole = F.expr("forall(embedding, x -> x IS NOT NULL AND abs(cast(x AS double)) < double('Infinity'))")
    whole &= F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    made = vectors.where(whole).select(
        F.col("vec_id").cast("long"),
        F.col("label").cast("long"),
        F.monotonically_increasing_id().alias("row"),
        F.size("embedding").alias("dims"),
        F.expr("transform(embedding, x -> cast(floor(256 * cast(x AS double)) AS bigint))").alias("values"),
        F.coalesce(F.expr(is_anchor), F.lit(False)).alias("is_anchor"),
    )
    made = materialise(made, "vectors")
    anchors = made.where("is_anchor")
    # anchors of all files fill blocks together
    tasks = max(1, -(-anchors.count() // ANCHORS))
    none = F.array().cast("array<bigint>").alias("limits")
    offered = blocks(made.select("*", none), CANDIDATES, "candidates")

    def asked(limits: DataFrame) -> DataFrame:
        return blocks(limits.repartition(tasks, "row"), ANCHORS, "anchors")

    every = F.array(F.lit(-LOWEST), F.lit(LOWEST)).alias("limits")
    nearest = best_of(scored(asked(anchors.select("*", every)), offered, 1, positives, True), positives)
    # scores are not negative here; decimals, as a multiple of a score may not fit into a long
    lower, upper = (F.expr(f"(cast(score AS decimal(20)) * {p} + {r}) div 100") for p, r in ((low, 99), (high, 0)))
    window = F.struct("rank", F.col("vec_id").alias("positive_id"), "score", lower.alias("lower"), upper.alias("upper"))
    # a handful of windows per anchor, by descending score and so by descending upper limit
    windows = nearest.where("score >= 0").groupBy(F.col("anchor").alias("row")).agg(F.array_sort(F.collect_list(window)).alias("windows"))
    windows = materialise(anchors.join(windows, "row").drop("is_anchor"), "windows")
    uppers = F.transform("windows", lambda w: w.upper)
    fill = F.array_repeat(F.lit(LOWEST), positives - F.size("windows"))
    limits = F.concat(uppers, fill, F.array(F.array_min(F.transform("windows", lambda w: w.lower))))
    lists = best_of(scored(asked(windows.withColumn("limits", limits)), offered, positives, k, False), k)
    held = lists.groupBy(F.col("anchor").alias("row")).agg(F.collect_list(F.struct("slot", "score", "vec_id", "row")).alias("held"))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in MINED.split(", ")]
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        for batch in batches:
            rows = []
            for anchor_id, of_anchor, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for w, best in suffix_merged(of_anchor, found, positives, k):
                    rows += [(anchor_id, w["positive_id"], i, x[1], w["score"], -x[0]) for i, x in enumerate(best, 1)]
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    both = windows.join(held, "row").select("vec_id", "windows", "held")
    return both.mapInArrow(answer, MINED)


SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
             list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER w AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(vectors.withColumn("label", moved), "vec_id % 100 = 0")
