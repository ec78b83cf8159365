"""The order mart kept in step with batches of change events.

Every batch goes through the same three steps, and each writes one partition of a table, named by the batch:

1. Per captured table: the batch's events are weighed against the stored newest events of the same keys. A key whose newest event
   changed gets a row with its new image and its old one.
2. Items: each change is the old image with a minus and the new one with a plus. They are summed per order, so totals are
   kept as differences and no order is counted anew.
3. Mart: the orders that changed, those whose totals changed and those of customers that changed are built again.

A step reads what earlier batches stored, reduced to the keys it needs before anything is shuffled, and writes what the
batch changes. A batch that is run again finds the tables as they were before it and replaces its own partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.current_state import flat_events, newest_per_key
from changeflow.operators.evolve import to_schema
from changeflow.operators.skew import hot_keys
from changeflow.plans.gold import GOLD_ORDER_SUMMARY, gold_from_totals
from changeflow.plans.shop import CUSTOMERS, ORDER_ITEMS, ORDERS, ShopTable
from changeflow.plans.silver import with_times
from changeflow.streaming.state import state_schema

TOTALS = "order_id bigint, item_count bigint, total_amount_cents bigint"
MART = f"{GOLD_ORDER_SUMMARY}, live boolean"
SOURCES = (CUSTOMERS, ORDERS, ORDER_ITEMS)


@dataclass(frozen=True)
class IncrementalMart:
    """The tables of a mart that is kept in step, all in ``schema``."""

    schema: str

    def name(self, part: str) -> str:
        return f"{self.schema}.step_{part}"

    def create(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.schema}")
        layouts = {t.name: changes_schema(t) for t in SOURCES}
        layouts |= {"totals": T.StructType.fromDDL(TOTALS), "mart": T.StructType.fromDDL(MART)}
        for part, schema in layouts.items():
            columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(part)} ({columns}, batch bigint) USING parquet PARTITIONED BY (batch)")

    def read(self, spark: SparkSession, part: str, until: int | None = None) -> DataFrame:
        """A part as of a batch; later partitions are not read."""
        rows = spark.table(self.name(part))
        return rows if until is None else rows.where(F.col("batch") <= until)

    def write(self, rows: DataFrame, part: str, batch: int) -> DataFrame:
        """Write a batch's partition of a part, in place of an earlier attempt, and read it again.

        An attempt that has no rows leaves what an earlier one wrote, so the partition goes first.
        """
        spark, name = rows.sparkSession, self.name(part)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch = {batch})")
        columns = [c for c in spark.table(name).columns if c != "batch"]
        rows.select(*columns, F.lit(batch).cast("bigint").alias("batch")).write.mode("append").insertInto(name)
        spark.catalog.refreshTable(name)
        return spark.table(name).where(F.col("batch") == batch)


def changes_schema(table: ShopTable) -> T.StructType:
    """The newest event of a key, and what was known before it as ``old``."""
    state = state_schema(table)
    return T.StructType([*state.fields, T.StructField("old", state)])


def semi(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` whose key is among ``keys``; the null key is a key like any other."""
    wanted = keys.select(F.col(key).alias("wanted")).distinct()
    return rows.join(wanted, F.col(key).eqNullSafe(F.col("wanted")), "left_semi")


def changed_rows(envelopes: DataFrame, stored: DataFrame, table: ShopTable) -> DataFrame:
    """Keys whose newest event is another one than ``stored`` says, in the columns of :func:`changes_schema`.

    Late events and copies that change nothing give no row.
    """
    names = state_schema(table).names
    fresh = newest_per_key(flat_events(envelopes, table.key, table.columns), table.key, table.columns).select(*names)
    known = newest_per_key(semi(stored, fresh, table.key).select(*names), table.key, table.columns)
    content = ", ".join(("ts_ms", "lsn", "op", *table.columns))
    row = f"struct({', '.join(names)})"
    both = known.select("*", F.lit(True).alias("known")).unionByName(fresh.select("*", F.lit(False).alias("known")))
    best = both.groupBy(table.key).agg(
        F.expr(f"max_by({row}, struct({content}))").alias("new"), F.expr(f"max(CASE WHEN known THEN {row} END)").alias("old")
    )
    return best.where(~F.col("new").eqNullSafe(F.col("old"))).select("new.*", "old")


def live(image: str = "") -> Column:
    """A key is live if its newest event has a code other than delete."""
    return F.coalesce(F.col(f"{image}op") != "d", F.lit(False))


def total_differences(changes: DataFrame) -> DataFrame:
    """By how much the batch changes each order's totals: old images of items count as minus, new ones as plus."""
    fields = ("order_item_id", "order_id", "quantity", "unit_price_cents", "op")
    images = [(-1, "old."), (1, "")]
    signed = F.array(*[F.struct(F.lit(sign).cast("bigint").alias("sign"), *[F.col(f"{p}{c}").alias(c) for c in fields]) for sign, p in images])
    line = F.col("quantity").cast("bigint") * F.col("unit_price_cents").cast("bigint")
    summed = (
        changes.select(F.inline(signed))
        .where(live())
        .groupBy("order_id")
        .agg(
            F.sum(F.when(F.col("order_item_id").isNotNull(), F.col("sign")).otherwise(0)).alias("item_count"),
            F.coalesce(F.sum(F.col("sign") * line), F.lit(0)).cast("bigint").alias("total_amount_cents"),
        )
    )
    return summed.where("item_count <> 0 OR total_amount_cents <> 0")


def touched_orders(mart: IncrementalMart, spark: SparkSession, batch: int, totals: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``order_id`` of the orders whose mart row a batch can change, each once."""
    names = F.col("full_name").eqNullSafe(F.col("old.full_name")) & F.col("email").eqNullSafe(F.col("old.email"))
    # what an order shows of its customer; a customer that came or went counts as changed
    renamed = customers.where(~(names & live().eqNullSafe(live("old."))))
    of_renamed = mart.read(spark, "orders", batch).join(renamed.select("customer_id").distinct(), "customer_id", "left_semi")
    parts = [totals, orders, of_renamed]
    return reduce(DataFrame.unionByName, [p.select("order_id") for p in parts]).distinct()


def apply_batch(spark: SparkSession, mart: IncrementalMart, batch: int, events: dict[str, DataFrame]) -> None:
    """Bring the mart in step with the envelopes of one batch, by table name; tables without events may be missing.

    Batches are numbered upwards. Only the last one may be run again.
    """
    mart.create(spark)
    changes = {}
    for table in SOURCES:
        stored = mart.read(spark, table.name, batch - 1)
        given = events.get(table.name)
        rows = changed_rows(given, stored, table) if given is not None else spark.createDataFrame([], changes_schema(table))
        changes[table.name] = mart.write(rows, table.name, batch)
    totals = mart.write(total_differences(changes["order_items"]), "totals", batch)
    touched = touched_orders(mart, spark, batch, totals, changes["orders"], changes["customers"])

    def now(table: ShopTable, keys: DataFrame) -> DataFrame:
        return newest_per_key(semi(mart.read(spark, table.name, batch), keys, table.key).drop("old", "batch"), table.key, table.columns)

    order_rows = now(ORDERS, touched)
    sums = semi(mart.read(spark, "totals", batch), touched, "order_id")
    sums = sums.groupBy("order_id").agg(*[F.sum(c).alias(c) for c in ("item_count", "total_amount_cents")])
    people = now(CUSTOMERS, order_rows).where(live())
    built = gold_from_totals(
        with_times(order_rows.where(live()).select(ORDERS.key, *ORDERS.columns), ORDERS), people, sums, hot_keys(order_rows, "customer_id")
    )
    gone = to_schema(order_rows.where(~live()).select("order_id"), built.schema)
    rows = built.withColumn("live", F.lit(True)).unionByName(gone.withColumn("live", F.lit(False)))
    mart.write(rows, "mart", batch)


def read_mart(spark: SparkSession, mart: IncrementalMart) -> DataFrame:
    """The mart as of the last batch: the newest row of every order that is there."""
    rank = "row_number() OVER (PARTITION BY order_id ORDER BY batch DESC)"
    newest = mart.read(spark, "mart").withColumn("rn", F.expr(rank)).where("rn = 1 AND live")
    return newest.select(*T.StructType.fromDDL(GOLD_ORDER_SUMMARY).names)
