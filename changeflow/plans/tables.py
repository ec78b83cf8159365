"""Namespaces, full-refresh tables, and publishing behind checks.

A model is written as a new table ``<schema>.<model>__<run>`` and becomes visible when the view
``<schema>.<model>`` is pointed at it: one catalog operation, so readers see the old rows or the new
ones, and a model may read its own previous version.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.contracts import enforce_shape
from changeflow.operators.evolve import to_schema, unified_schema, union_sql

NAMESPACES = ("bronze", "silver", "gold", "ops")


class PublishBlocked(RuntimeError):
    """The staged table failed its checks and was not made visible."""

    def __init__(self, model: str, results: list) -> None:
        super().__init__(f"{model}: " + "; ".join(str(r.asDict()) for r in results))
        self.results = results


@dataclass(frozen=True)
class Published:
    name: str
    version: str
    rows: int


def create_namespaces(spark: SparkSession, names: Iterable[str] = NAMESPACES) -> None:
    """Must run first: writing into a namespace that does not exist fails."""
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def model_name(model: str, schema: str | None, default: str = "silver") -> str:
    """A model's own schema is used as it is, not appended to the default one."""
    return f"{(schema or default).strip()}.{model}"


def versions(spark: SparkSession, model: str) -> list[str]:
    """Tables written for a model, newest first; run names sort by time."""
    schema, name = model.split(".")
    if not spark.catalog.databaseExists(schema):
        return []
    found = spark.sql(f"SHOW TABLES IN {schema} LIKE '{name}__*'").select("tableName").collect()
    return sorted((f"{schema}.{r.tableName}" for r in found), reverse=True)


#: Marks a version that readers may have seen; what lacks it was blocked or never finished.
PUBLISHED = "changeflow.published"


def stage(df: DataFrame, model: str, run: str, contract: str | None = None) -> Published:
    """Write a model in full under a name of its own, which no other attempt shares, and show it to nobody.

    ``contract`` is checked on the plan before anything is written. ``run`` names must sort by time; attempts
    of a run are told apart by the time they began.
    """
    spark = df.sparkSession
    if contract is not None:
        df = enforce_shape(df, contract)
    version = f"{model}__{run}_{time.time_ns():020d}"
    written = Observation(version)
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.saveAsTable(version)
    return Published(model, version, written.get["rows"])


def promote(spark: SparkSession, staged: Published, keep: int = 2) -> Published:
    """Show a staged version to readers and drop what is older than the ``keep`` newest shown ones.

    The version shown until now is always among those kept, and blocked ones do not count.
    """
    spark.sql(f"ALTER TABLE {staged.version} SET TBLPROPERTIES ('{PUBLISHED}' = 'true')")
    spark.sql(f"CREATE OR REPLACE VIEW {staged.name} AS SELECT * FROM {staged.version}")
    shown = [v for v in versions(spark, staged.name) if v != staged.version and _was_shown(spark, v)]
    kept = [staged.version, *shown[: keep - 1]]
    for old in versions(spark, staged.name):
        if old not in kept and old < min(kept):
            spark.sql(f"DROP TABLE IF EXISTS {old}")
    return staged


def _was_shown(spark: SparkSession, version: str) -> bool:
    return not spark.sql(f"SHOW TBLPROPERTIES {version}").where(F.col("key") == PUBLISHED).isEmpty()


def publish(
    df: DataFrame,
    model: str,
    run: str,
    contract: str | None = None,
    audit: Callable[[DataFrame], DataFrame] | None = None,
    keep: int = 2,
) -> Published:
    """Stage a model, check it, and make it visible.

    ``audit`` turns the staged table into a report with a ``success`` column; only its few failing rows come
    to the driver. A blocked version stays for inspection.
    """
    spark = df.sparkSession
    staged = stage(df, model, run, contract)
    if audit is not None:
        block(model, audit(spark.table(staged.version)))
    return promote(spark, staged, keep)


def block(model: str, report: DataFrame) -> None:
    """Raise if a report has rows without success."""
    failures = report.where(~F.col("success")).collect()
    if failures:
        raise PublishBlocked(model, failures)


def raw_version(spark: SparkSession, name: str, incoming: T.StructType) -> str:
    """The table that rows of a raw table go to, made if there is none that can hold them.

    A raw table is a view ``name`` over its versions ``name__v000001`` and so on. Rows that lack columns or nested
    fields of the newest version fit into it. If they have more, or wider numbers, the next version takes the
    unified schema, the old files stay as they are, and the view reads all versions in it. What has no common
    type is refused. A plain table of that name becomes the first version.
    """
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__v000000")
    known = {v: spark.table(v).schema for v in versions(spark, name)}
    newest = next(iter(known), None)
    unified = unified_schema(known[newest], incoming) if newest else incoming
    if newest and unified.simpleString() == known[newest].simpleString():
        version = newest
    else:
        version = f"{name}__v{int(newest.rpartition('__v')[2]) + 1 if newest else 1:06d}"
        spark.createDataFrame([], unified).write.saveAsTable(version)
        known[version] = spark.table(version).schema
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {union_sql(dict(sorted(known.items())))}")
    return version


def append_raw(df: DataFrame, name: str) -> None:
    """Append events to a raw table, created on first use and grown by a version where they need it."""
    spark = df.sparkSession
    version = raw_version(spark, name, df.schema)
    to_schema(df, spark.table(version).schema).write.insertInto(version)


def compact_raw(spark: SparkSession, name: str) -> str:
    """Rewrite a raw table's versions as one with few, large files, and point the view at it.

    Meant for a table that no stream is writing just now. The old versions are dropped when the view has moved,
    so readers that start before or after see all rows once.
    """
    old = versions(spark, name)
    number = max(int(v.rpartition("__v")[2]) for v in old) + 1
    version = f"{name}__v{number:06d}"
    spark.table(name).hint("rebalance").write.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for v in old:
        spark.sql(f"DROP TABLE {v}")
    return version
