"""Exact dedup: sorted runs of digests, merged over a tree of partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from changeflow.operators.skew import hot_from_counts, salted_left_join
from changeflow.session import materialise

#: Runs that meet in one merge.
FAN_IN = 32

ENTRY = "slice int, run int, print binary, keep_id long, keep_row long, n long"


def normalised(text: str):
    """The text with every run of ASCII white space as one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge adjacent entries of one run with the same print; entries come sorted, so the first one stays.

    The last entry of a batch waits for the next batch, which is all that is held.
    """
    held = None
    for batch in batches:
        batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)  # all columns nullable
        table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
        if not table.num_rows:
            continue
        run, part = table["run"].to_numpy(), table["slice"].to_numpy()
        prints = np.array(table["print"].to_pylist(), dtype="S48")
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (part[1:] != part[:-1]) | (prints[1:] != prints[:-1])
        first = np.flatnonzero(new)
        merged = table.take(pa.array(first))
        n = np.add.reduceat(table["n"].to_numpy(), first)
        merged = merged.set_column(merged.schema.get_field_index("n"), "n", pa.array(n, pa.int64()))
        merged = merged.combine_chunks()
        yield from merged.slice(0, len(first) - 1).to_batches()
        held = merged.slice(len(first) - 1).to_batches()[0]
    if held is not None:
        yield held


def merged_runs(leaves: DataFrame, slices: int, fan_in: int = FAN_IN) -> DataFrame:
    """One entry per print: ``print, keep_id, keep_row, n``, from ``leaves`` with ``print, doc_id, row, run``.

    Each partition sorts and folds its own rows. Then, round by round, the runs whose numbers agree but
    for their last digit (base ``fan_in``) meet: sorted by print they are merged, and of equal prints the
    smallest identifier and the sum of the counts go on. Prints are cut into ``slices`` by their leading
    bytes, so the last round ends in one run per slice and no task ever sees them all. A print that fills
    a third of the table costs one entry per run.
    """
    spark = leaves.sparkSession
    last = leaves.agg(F.max("run")).first()[0] or 0
    place = F.conv(F.hex(F.substring("print", 1, 4)), 16, 10).cast("long")
    order = ["slice", "run", "print", F.col("keep_id").asc_nulls_last(), "keep_row"]
    runs = (
        leaves.select(
            F.floor(place * slices / F.lit(2**32)).cast("int").alias("slice"),
            F.col("run").cast("int"),
            "print",
            F.col("doc_id").alias("keep_id"),
            F.col("row").alias("keep_row"),
            F.lit(1).cast("long").alias("n"),
        )
        .sortWithinPartitions(*order)
        .mapInArrow(fold, ENTRY)
    )
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    while last:
        last //= fan_in
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
            .repartition(parts, "slice", "run")
            .sortWithinPartitions(*order)
            .mapInArrow(fold, ENTRY)
        )
    return runs.select("print", "keep_id", "keep_row", "n")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Groups of equal normalised texts in ``docs`` (``doc_id, text``), a row per document.

    Columns: ``doc_id, text_hash`` (64-bit, of the text as it is), ``keep_id, group_size, kept, text_sha256``.
    Entries are equal only if SHA-256, length and a second, independent hash of the text agree; that is
    checked in every merge. Null texts count as empty, empty texts form a group. Of equal texts the row
    with the smallest ``doc_id`` stays; a null ``doc_id`` comes after all others, and of rows that repeat
    it exactly one stays. An empty table gives no rows.
    """
    text = normalised("text")
    raw = F.encode(text, "UTF-8")
    prints = F.concat(
        F.unhex(F.sha2(raw, 256)), F.unhex(F.lpad(F.hex(F.xxhash64(text)), 16, "0")),
        F.unhex(F.lpad(F.hex(F.octet_length(raw).cast("long")), 16, "0")),
    )
    leaves = materialise(
        docs.select(
            "doc_id",
            prints.alias("print"),
            F.xxhash64("text").alias("text_hash"),
            F.monotonically_increasing_id().alias("row"),
            F.spark_partition_id().alias("run"),
        ),
        "digests",
    )
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = materialise(merged_runs(leaves, slices), "groups")
    joined = salted_left_join(leaves, groups, "print", "row", hot_from_counts(groups, "print", "n"))
    return joined.select(
        "doc_id",
        "text_hash",
        "keep_id",
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex(F.substring("print", 1, 32))).alias("text_sha256"),
    )


def row_keys(doc_id: str, text_hash: Column) -> dict[str, Column]:
    """Join keys of a document row that are never null: its identifier as text and the hash of its text."""
    return {"_id": F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "_hash": text_hash}


def whole_rows(docs: DataFrame) -> DataFrame:
    """Rows as one column ``doc``, so that no name of theirs can clash, with their :func:`row_keys`."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc")).withColumns(
        row_keys("doc.doc_id", F.xxhash64("doc.text"))
    )


def one_of_each(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` and ``text_hash`` are in ``kept``; of rows alike in both exactly one."""
    keys = kept.select(*[c.alias(n) for n, c in row_keys("doc_id", F.col("text_hash")).items()])
    left = whole_rows(docs).join(keys, ["_id", "_hash"], "left_semi")
    one = F.row_number().over(W.partitionBy("_id", "_hash").orderBy("_id"))
    return left.withColumn("_nth", one).where("_nth = 1").select("doc.*")


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay; of rows alike in ``doc_id`` and text exactly one."""
    return one_of_each(docs, exact_groups(docs).where("kept"))


SQL = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)
"""


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
