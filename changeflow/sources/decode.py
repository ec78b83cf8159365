"""Message text to envelopes and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.sources.envelope import envelope_schema


def encode_envelopes(bronze: DataFrame, key: str) -> DataFrame:
    """Envelopes as topic messages: key text and JSON value."""
    return bronze.select(
        F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")).cast("string").alias("key"),
        F.to_json(F.struct("before", "after", "op", "ts_ms", "source")).alias("value"),
    )


def drop_tombstones(messages: DataFrame) -> DataFrame:
    """A message without a value carries no event."""
    return messages.where(F.col("value").isNotNull())


def decode_envelopes(messages: DataFrame, image: str, fail_fast: bool = True, keep: dict[str, Column] | None = None) -> DataFrame:
    """Parse JSON values against the registered envelope; ``keep`` adds columns of the message.

    By default a record that does not parse stops the job rather than being skipped. Otherwise its
    unreadable parts come out NULL.
    """
    parsed = F.from_json("value", envelope_schema(image), {"mode": "FAILFAST" if fail_fast else "PERMISSIVE"})
    if fail_fast:
        # the parser takes blank text for a missing value
        parsed = F.when(F.trim("value") == "", F.raise_error(F.lit("MALFORMED_RECORD: blank message"))).otherwise(parsed)
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    return drop_tombstones(messages).select(parsed.alias("e"), *kept).select("e.*", *(keep or {}))


def position(messages: DataFrame) -> dict[str, Column]:
    """Where a message stood, as far as its source tells: key, topic, partition and offset."""
    names = {"message_key": "key", "topic": "topic", "partition": "partition", "offset": "offset"}
    return {name: F.col(c) for name, c in names.items() if c in messages.columns}


def beyond(image: str) -> Column:
    """Fields of a message's row image that ``image`` does not list, as text by name; NULL if there are none."""
    known = [F.lit(n) for n in envelope_schema(image)["after"].dataType.names]
    read = F.from_json("value", "before map<string, string>, after map<string, string>")
    rest = F.map_filter(F.coalesce(read["after"], read["before"]), lambda k, _: ~F.array_contains(F.array(*known), k))
    return F.when(F.size(rest) > 0, rest)


def decode_avro(messages: DataFrame, schema: str, header_bytes: int = 5, fail_fast: bool = True) -> DataFrame:
    """The same from Avro values, given the envelope's Avro schema; needs the Spark Avro package.

    ``header_bytes`` is how much the registry's serializer puts in front: a marker byte and the schema id.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.expr(f"substring(value, {header_bytes + 1})")
    mode = "FAILFAST" if fail_fast else "PERMISSIVE"
    return drop_tombstones(messages).select(from_avro(body, schema, {"mode": mode}).alias("e")).select("e.*")
