"""Mixing sources to target weights: hash-random order, distributed prefix sums, exact budgets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changeflow.llm.exact_dedup import row_keys, whole_rows
from changeflow.session import materialise

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    """Words of a text as maximal runs of anything but ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def running_sums(df: DataFrame, by: Sequence[Column], values: dict[str, str]) -> DataFrame:
    """Adds for each ``{new: column}`` the sum of ``column`` over all rows before this one in the order ``by``.

    Rows are range-sorted and staged; only the totals of the ranges, as many as shuffle partitions, meet
    in one task.
    """
    ranged = materialise(df.repartitionByRange(*by).withColumn("part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("part").agg(*[F.sum(c).alias(new) for new, c in values.items()])
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(
        "part", *[F.coalesce(F.sum(new).over(earlier), F.lit(0)).alias(f"{new}_base") for new in values]
    )
    within = W.partitionBy("part").orderBy(*by).rowsBetween(W.unboundedPreceding, -1)
    return (
        ranged.join(bases, "part")
        .withColumns(
            {new: F.col(f"{new}_base") + F.coalesce(F.sum(c).over(within), F.lit(0)) for new, c in values.items()}
        )
        .drop("part", *[f"{new}_base" for new in values])
    )


def source_targets(sizes: DataFrame, weights: Sequence[int], share: float, cap: float) -> DataFrame:
    """A row per source: ``source, source_size, n_rows, place`` (from 1, by code point, null last), ``target``.

    The sources share ``share`` of all sizes by their weights, which repeat over the places. No target is
    above ``cap`` times its source's size; what is too much goes to the others by weight. That is the level
    ``L`` at which the targets ``min(cap * size, L * weight)`` add up to the whole. In the order of
    ``cap * size / weight`` it is the largest of (whole - caps before) / (weights from here on).
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    placed = running_sums(sources.withColumn("one", F.lit(1)), [F.col("source").asc_nulls_last()], {"place": "one"})
    turn = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    weighed = placed.withColumn("weight", turn.cast("long")).withColumn("place", F.col("place") + 1)
    order = [(F.lit(float(cap)) * F.col("source_size") / F.col("weight")).asc(), F.col("place").asc()]
    before = running_sums(weighed.drop("one"), order, {"size_before": "source_size", "weight_before": "weight"})
    before = materialise(before, "levels")
    whole = before.agg((F.sum("source_size") * float(share)).alias("x")).scalar()
    weight = before.agg(F.sum("weight").alias("x")).scalar()
    level = (whole - F.lit(float(cap)) * F.col("size_before")) / (weight - F.col("weight_before"))
    top = before.agg(F.max(level).alias("x")).scalar()
    target = F.least(F.lit(float(cap)) * F.col("source_size"), top * F.col("weight"))
    return before.select("source", "source_size", "n_rows", "place", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix"
) -> DataFrame:
    """How many words the mix takes of each document of ``docs`` (``doc_id, text, source``).

    Returns per row ``doc_id, source, digest`` (a 64-bit hash of the text), ``size, source_size, target, taken``.
    A source whose target holds its whole size several times is taken that often (an epoch each); the rest
    of the target is filled in the order of a key hashed from ``doc_id`` and ``seed``. The document at the
    cut gives only its first words, so a source's ``taken`` adds up to its rounded target.

    Keys are spread evenly, so equal ranges of keys are even parts: each source has as many ranges as its
    share of the rows asks for. Ranges are summed, and the sums before a range are added to the prefix sums
    within it. Null and empty texts have size 0 and are never taken; a null source is a source of its own;
    rows with a null or repeated ``doc_id`` are ordered by size and text hash behind their common key;
    an empty table gives no rows.
    """
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f"/{seed}")).cast("binary"))
    sized = materialise(
        docs.select("doc_id", "source", F.xxhash64("text").alias("digest"), word_count("text").alias("size")), "sizes"
    )
    targets = source_targets(sized, weights, share, cap)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n_parts = F.ceil(F.lit(4 * parts) * F.col("n_rows") / targets.agg(F.sum("n_rows").alias("x")).scalar())
    targets = targets.withColumn("n_parts", n_parts).withColumnRenamed("source", "of")
    spread = F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / float(16**8)
    keyed = (
        sized.withColumn("key", key)
        .join(targets, sized["source"].eqNullSafe(targets["of"]))
        .withColumn("part", F.floor(spread * F.col("n_parts")))
        .drop("of")
    )
    earlier = W.partitionBy("place").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    bases = (
        keyed.groupBy("place", "part")
        .agg(F.sum("size").alias("part_size"))
        .select("place", "part", F.coalesce(F.sum("part_size").over(earlier), F.lit(0)).alias("base"))
    )
    within = W.partitionBy("place", "part").orderBy("key", "doc_id", "size", "digest")
    before = F.coalesce(F.sum("size").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.round("target").cast("long") - epochs * F.col("source_size")
    partly = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("base") - F.col("before")))
    return (
        keyed.join(bases, ["place", "part"])
        .withColumn("before", before)
        .select(
            "doc_id",
            "source",
            "digest",
            "size",
            "source_size",
            "target",
            (epochs * F.col("size") + partly).cast("long").alias("taken"),
        )
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; a last, partial take counts from half a document on.

    Rows alike in ``doc_id`` and text share what the mix takes of them evenly.
    """
    times = F.sum("taken") / F.greatest(F.sum("size"), F.lit(1))
    taken = mix(docs, **how).withColumns(row_keys("doc_id", F.col("digest"))).groupBy("_id", "_hash").agg(times.alias("times"))
    return (
        whole_rows(docs)
        .join(taken, ["_id", "_hash"])
        .where("times >= 0.5")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.floor(F.col("times") + 0.5))))
        .select("doc.*")
    )


#: The same in DuckDB.
SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || '/mix') AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())
             - 2.0::DOUBLE * (sum(source_size) OVER o - source_size)) / (sum(weight) OVER () - sum(weight) OVER o + weight)
            AS level
  FROM sources WINDOW o AS (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
targets AS (
  SELECT *, least(2.0::DOUBLE * source_size, max(level) OVER () * weight)::DOUBLE AS target FROM levels),
cut AS (
  SELECT doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs,
         coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target)::BIGINT - epochs * source_size - before)))::BIGINT AS taken
FROM cut
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
