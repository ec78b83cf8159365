"""Exact top-k search by inner product: branch and bound over blocks of dimensions in columnar layout."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changeflow.session import materialise

#: Vectors of a candidate block and of a query block, and dimensions added up between two cuts.
CANDIDATES = 1024
QUERIES = 1024
DIMENSIONS = 8

#: Share of pairs below which they are carried on one by one, and blocks that a task takes one after the other at least,
#: so that the later ones meet the scores of the first.
FEW = 1 / 8
BLOCKS = 8


class Best:
    """The best ``k`` (score, smaller id first) of each query so far."""

    def __init__(self, queries: int, k: int) -> None:
        self.k = k
        self.score = np.full((queries, k), -np.iinfo(np.int64).max)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)
        self.row = np.full((queries, k), -1)

    def least(self) -> np.ndarray:
        """A candidate below this score is out; at it, a smaller id could still count."""
        return self.score[:, -1]

    def offer(self, query: int, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        score = np.concatenate([self.score[query], score])
        ids = np.concatenate([self.id[query], ids])
        rows = np.concatenate([self.row[query], rows])
        order = np.lexsort((rows, ids, -score))[: self.k]
        self.score[query], self.id[query], self.row[query] = score[order], ids[order], rows[order]


def exact(values: np.ndarray) -> np.ndarray:
    """As floating point numbers, where their products add up exactly, so that they can be multiplied fast."""
    most = int(np.abs(values).max(initial=0))
    return values.astype(np.float64) if most * most * max(1, values.shape[0]) < 2**52 else values


def search_block(queries: np.ndarray, query_rows: np.ndarray, block: np.ndarray, ids: np.ndarray, rows: np.ndarray, best: Best) -> int:
    """Offer to ``best`` what can still be among the best of each query; returns the products computed.

    ``queries`` and ``block`` are columnar: a dimension per row, taken here by falling energy. Scores are added up a block
    of dimensions at a time. What the rest can add is at most the sum, over the blocks to come, of the products of the lengths
    that both have in them (Cauchy-Schwarz). A candidate whose sum and rest stay below the k-th best of a query, or below the k-th
    largest of the sums less their rests in the block, is out for that query. A block is compacted to the candidates that at
    least one query still needs; once few pairs are left, only those are carried on.
    """
    dims, n_queries = queries.shape
    if dims != block.shape[0] or not n_queries or not block.shape[1]:
        return 0
    both = exact(np.concatenate([queries, block], 1))
    squares = both.astype(np.float64) ** 2
    falling = np.argsort(-(squares[:, :n_queries].sum(1) * squares[:, n_queries:].sum(1)), kind="stable")
    both, squares = both[falling], squares[falling]
    q, c = both[:, :n_queries], both[:, n_queries:]
    edges = np.arange(0, dims, DIMENSIONS)
    lengths = np.sqrt(np.add.reduceat(squares, edges, 0))
    of_q, of_c = lengths[:, :n_queries], lengths[:, n_queries:]
    sums = np.zeros((n_queries, c.shape[1]), both.dtype)
    alive = query_rows[:, None] != rows[None, :]
    done = 0
    for i, at in enumerate(edges.tolist()):
        stop = min(at + DIMENSIONS, dims)
        sums += q[at:stop].T @ c[at:stop]
        done += n_queries * c.shape[1] * (stop - at)
        if stop == dims:
            break
        slack = of_q[i + 1 :].T @ of_c[i + 1 :] * (1 + 1e-9) + 1
        floor = best.least().astype(np.float64)
        if c.shape[1] > best.k:
            low = np.where(alive, sums - slack, -np.inf)
            floor = np.maximum(floor, np.partition(low, -best.k, 1)[:, -best.k])
        alive &= sums + slack >= floor[:, None]
        if alive.sum() <= FEW * alive.size:
            return done + finish(q, c, of_q, of_c, i + 1, *np.nonzero(alive), sums, floor, ids, rows, best)
        needed = alive.any(0)
        if needed.mean() < 0.8:
            c, of_c, sums, alive, ids, rows = c[:, needed], of_c[:, needed], sums[:, needed], alive[:, needed], ids[needed], rows[needed]
            if not c.shape[1]:
                return done
    for query in np.flatnonzero((alive & (sums >= best.least()[:, None])).any(1)):
        take = np.flatnonzero(alive[query] & (sums[query] >= best.score[query, -1]))
        best.offer(query, sums[query, take].astype(np.int64), ids[take], rows[take])
    return done


def finish(q, c, of_q, of_c, block: int, query, place, sums, floor, ids, rows, best: Best) -> int:
    """Carry single pairs, ``query`` and ``place`` of a candidate, from a block of dimensions to the last; returns the products computed."""
    sums, done = sums[query, place], 0
    for i in range(block, len(of_q)):
        at, stop = i * DIMENSIONS, min((i + 1) * DIMENSIONS, len(q))
        sums = sums + np.einsum("dn,dn->n", q[at:stop][:, query], c[at:stop][:, place])
        done += len(query) * (stop - at)
        rest = np.einsum("dn,dn->n", of_q[i + 1 :][:, query], of_c[i + 1 :][:, place]) * (1 + 1e-9) + 1
        on = sums + rest >= floor[query]
        query, place, sums = query[on], place[on], sums[on]
    begins = np.flatnonzero(np.concatenate([[True], query[1:] != query[:-1]])) if len(query) else query
    for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(query)], strict=True) if len(query) else ():
        best.offer(int(query[a]), sums[a:b].astype(np.int64), ids[place[a:b]], rows[place[a:b]])
    return done


def blocks(vectors: DataFrame, size: int, per: str) -> DataFrame:
    """Pack ``(dims, row, vec_id, values)`` into columnar blocks ``(dims, ids, rows, columns)``, ``size`` at most, by ``per``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}

        def block(dims: int) -> pa.RecordBatch:
            rows = held.pop(dims)
            values = np.array([r[2] for r in rows], np.int64).reshape(len(rows), dims)
            columns = np.ascontiguousarray(values.T).tobytes()
            ids, numbers = (np.array([r[i] for r in rows], np.int64).tobytes() for i in (0, 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([dims], pa.int32()), *(pa.array([x], pa.binary()) for x in (ids, numbers, columns))],
                names=["dims", "ids", "rows", "columns"],
            )

        for batch in batches:
            for dims, row, vec_id, values in zip(*(batch[c].to_pylist() for c in ("dims", "row", "vec_id", "values")), strict=True):
                held.setdefault(dims, []).append((vec_id, row, values))
                if len(held[dims]) == size:
                    yield block(dims)
        for dims in list(held):
            yield block(dims)

    packed = vectors.select("dims", "row", "vec_id", "values").mapInArrow(pack, "dims int, ids binary, rows binary, columns binary")
    return materialise(packed, per)


FOUND = "query_row long, query_id long, vec_id long, row long, score long"


def top_k(vectors: DataFrame, is_query: str, k: int = 10, queries: int = QUERIES, candidates: int = CANDIDATES) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row of ``vectors`` (``vec_id, embedding``) its ``k`` best others.

    Components become ``floor(1024 * x)`` and scores are integer inner products, ties going to the smaller
    ``vec_id``. ``is_query`` is an SQL condition on a row. Vectors that are null or hold a null or non-finite
    component take no part, nor do rows without ``vec_id``; vectors meet only others of their length. A row
    is not its own candidate, but a repeated row is one to its copies.

    Each query block meets each group of candidate blocks in one task, which holds that query block and one
    candidate block. Best lists of the groups, ``k`` rows per query and group, are merged at the end.
    """
    whole = F.expr("forall(embedding, x -> x IS NOT NULL AND abs(cast(x AS double)) < double('Infinity'))")
    made = materialise(
        vectors.where(whole & F.col("embedding").isNotNull() & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long"),
            F.monotonically_increasing_id().alias("row"),
            F.size("embedding").alias("dims"),
            F.expr("transform(embedding, x -> cast(floor(1024 * cast(x AS double)) AS bigint))").alias("values"),
            F.coalesce(F.expr(is_query), F.lit(False)).alias("is_query"),
        ),
        "vectors",
    )
    numbered = F.monotonically_increasing_id()
    asked = blocks(made.where("is_query"), queries, "queries").withColumn("block", numbered)
    offered = blocks(made, candidates, "candidates")
    parts = min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), max(1, -(-offered.count() // BLOCKS)))
    offered = offered.withColumn("part", F.pmod(F.xxhash64("ids", "rows"), F.lit(parts)))
    left = asked.select("dims", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), F.lit(0).alias("kind"), "ids", "rows", "columns")
    of = asked.groupBy("dims").agg(F.collect_list("block").alias("blocks"))
    right = offered.join(of, "dims").select(
        "dims", F.explode("blocks").alias("block"), F.col("part").cast("int"), F.lit(1).alias("kind"), "ids", "rows", "columns"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, best, asking = None, None, None

        def found() -> Iterator[pa.RecordBatch]:
            if best is not None:
                query, place = np.nonzero(best.row >= 0)
                columns = [asking[2][query], asking[1][query], best.id[query, place], best.row[query, place], best.score[query, place]]
                names = ["query_row", "query_id", "vec_id", "row", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "rows"))
                columns = np.frombuffer(row["columns"], np.int64).reshape(row["dims"], len(ids))
                if row["kind"] == 0:
                    yield from found()
                    key, asking, best = (row["block"], row["part"]), (columns, ids, rows), Best(len(ids), k)
                elif key == (row["block"], row["part"]):
                    search_block(asking[0], asking[2], columns, ids, rows, best)
        yield from found()

    met = left.unionByName(right).repartition("block", "part").sortWithinPartitions("block", "part", "kind")
    lists = met.select("dims", "block", "part", "kind", "ids", "rows", "columns").mapInArrow(search, FOUND)
    order = W.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return (
        lists.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int"), "vec_id", "score")
    )


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 10
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")
