"""Schema contracts: the shape of an output, and whether each event conforms to its registered schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.functions.iso8601 import parse_iso8601
from changeflow.operators.asof import asof_join


class ContractViolation(ValueError):
    """An output's columns or types differ from its declaration."""


def shape_differences(actual: T.StructType, declared: T.StructType) -> list[str]:
    """Missing, extra and retyped columns. Order and nullability are free."""
    have = {f.name: f.dataType for f in actual}
    want = {f.name: f.dataType for f in declared}
    return (
        [f"missing {c}" for c in want if c not in have]
        + [f"extra {c}" for c in have if c not in want]
        + [
            f"{c} is {have[c].simpleString()}, declared {want[c].simpleString()}"
            for c in want
            if c in have and have[c] != want[c]
        ]
    )


def enforce_shape(df: DataFrame, declared: str) -> DataFrame:
    """The frame with its columns in declared order; raises before anything is written if it differs."""
    schema = T.StructType.fromDDL(declared)
    differences = shape_differences(df.schema, schema)
    if differences:
        raise ContractViolation("; ".join(differences))
    return df.select(*schema.names)


def castability(df: DataFrame, declared: str) -> DataFrame:
    """Per declared column, how many present values cannot be held by the declared type. One pass."""
    schema = T.StructType.fromDDL(declared)
    counts, rows = [], []
    for f in schema:
        kind = f.dataType.simpleString()
        counts += [
            f"count({f.name}) AS seen_{f.name}",
            f"count_if({f.name} IS NOT NULL AND try_cast({f.name} AS {kind}) IS NULL) AS lost_{f.name}",
        ]
        rows.append(
            f"named_struct('column', '{f.name}', 'expected', '{kind}', 'evaluated', seen_{f.name}, "
            f"'not_castable', lost_{f.name})"
        )
    return df.selectExpr(*counts).selectExpr(f"inline(array({', '.join(rows)}))")


# JSON kinds a reader of each declared type accepts; an integer may be read as a float.
INTEGERS = ("tinyint", "smallint", "int", "bigint")
ACCEPTED_KINDS = {
    **dict.fromkeys(INTEGERS, ("BIGINT",)),
    "float": ("BIGINT", "DECIMAL", "DOUBLE"),
    "double": ("BIGINT", "DECIMAL", "DOUBLE"),
    "decimal": ("BIGINT", "DECIMAL"),
    "string": ("STRING",),
    "boolean": ("BOOLEAN",),
    "date": ("STRING",),
    "timestamp": ("STRING",),
    "array": ("ARRAY",),
    "map": ("OBJECT",),
    "struct": ("OBJECT",),
}
# Types that a newer reader may widen to.
PROMOTIONS = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "float", "double"),
    "bigint": ("float", "double"),
    "float": ("double",),
}
# What a subject asks of a new version of its contract.
RULES = ("BACKWARD", "NONE")


def refuse_unknown(kind: T.DataType, path: str) -> None:
    """Raises for a type that no rule is known for, at any depth; a map's keys are text in JSON."""
    if kind.typeName() not in ACCEPTED_KINDS and kind.simpleString() not in ACCEPTED_KINDS:
        raise ContractViolation(f"{path or 'contract'}: no rule for {kind.simpleString()}")
    if isinstance(kind, T.StructType):
        for f in kind:
            refuse_unknown(f.dataType, f"{path}.{f.name}".lstrip("."))
    elif isinstance(kind, T.ArrayType):
        refuse_unknown(kind.elementType, f"{path}[]")
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise ContractViolation(f"{path}: no rule for {kind.simpleString()}")
        refuse_unknown(kind.valueType, f"{path}{{}}")


def type_differences(old: T.DataType, new: T.DataType, path: str, defaults: tuple[str, ...] = ()) -> list[str]:
    """Why a reader of ``new`` cannot read ``old``, by path: fields by name, ``[]`` for elements, ``{}`` for values."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        before, found = {f.name: f.dataType for f in old}, []
        for f in new:
            inner = f"{path}.{f.name}".lstrip(".")
            if f.name in before:
                found += type_differences(before[f.name], f.dataType, inner, defaults)
            elif inner not in defaults:
                found.append(f"{inner} added without default")
        return found
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return type_differences(old.elementType, new.elementType, f"{path}[]", defaults)
    if isinstance(old, T.MapType) and isinstance(new, T.MapType):
        return type_differences(old.valueType, new.valueType, f"{path}{{}}", defaults)
    before, after = old.simpleString(), new.simpleString()
    if before == after or after in PROMOTIONS.get(before, ()):
        return []
    return [f"{path} changed from {before} to {after}"]


def backward_differences(old: str, new: str, defaults: tuple[str, ...] = ()) -> list[str]:
    """Why a reader of ``new`` cannot read data of ``old``, at any depth; empty if it can.

    Fields may go, come with a default (``defaults`` holds their paths), or be widened; decimals and times must stay as
    they are. A type without a rule is refused by name.
    """
    schemas = [T.StructType.fromDDL(c) for c in (old, new)]
    for s in schemas:
        refuse_unknown(s, "")
    added = [d for d in type_differences(*schemas, "", defaults) if d.endswith("without default")]
    return added + [d for d in type_differences(*schemas, "", defaults) if d not in added]


REGISTRY = "subject string, version int, valid_from bigint, rule string, contract string"


def empty_registry(spark: SparkSession) -> DataFrame:
    """A registry without versions."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(REGISTRY)])


def register(
    registry: DataFrame, subject: str, valid_from: int, contract: str, rule: str | None = None, defaults: tuple[str, ...] = ()
) -> DataFrame:
    """The row that makes ``contract`` the next version of ``subject``, to be appended to ``registry``.

    ``registry`` has a row per version (:data:`REGISTRY`). A subject's rule is its newest version's unless another is
    given, BACKWARD at first. Raises, before anything is written, if the rule forbids the change, a type has no rule, or
    the version would begin before the newest.
    """
    refuse_unknown(T.StructType.fromDDL(contract), "")
    newest = registry.where(F.col("subject") == subject).orderBy(F.desc("version")).first()
    rule = rule or (newest.rule if newest else "BACKWARD")
    if rule not in RULES:
        raise ValueError(f"{subject}: rule {rule} is none of {', '.join(RULES)}")
    if newest is not None:
        if valid_from <= newest.valid_from:
            raise ContractViolation(f"{subject}: version {newest.version} holds from {newest.valid_from} already")
        found = backward_differences(newest.contract, contract, defaults) if rule == "BACKWARD" else []
        if found:
            raise ContractViolation(f"{subject}: " + "; ".join(found))
    row = (subject, newest.version + 1 if newest else 1, valid_from, rule, contract)
    fields = T.StructType.fromDDL(REGISTRY)
    return registry.sparkSession.range(1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, fields, strict=True)])


def _verdict(value: Column, kind: T.DataType) -> Column:
    """``ok``, ``type_mismatch`` or ``out_of_range`` for a variant that is there. JSON null is ok for any type."""
    name = kind.typeName() if kind.typeName() in ACCEPTED_KINDS else kind.simpleString()
    seen = F.schema_of_variant(value)
    accepted = reduce(lambda x, y: x | y, [seen.startswith(k) for k in ACCEPTED_KINDS[name]])
    as_type = lambda t: F.try_variant_get(value, "$", t)
    worst = None  # the worst verdict of what is within
    if name in INTEGERS:
        fits = as_type(name).isNotNull()
    elif name == "decimal":
        narrow = as_type(kind.simpleString())
        fits = narrow.isNotNull() & narrow.eqNullSafe(as_type(f"decimal(38,{max(kind.scale, 18)})"))
    elif name == "timestamp":
        accepted &= parse_iso8601(as_type("string")).isNotNull()
    elif name == "date":
        accepted &= F.try_to_date(as_type("string"), "yyyy-MM-dd").isNotNull()
    elif name == "array":
        worst = _worst(F.transform(as_type("array<variant>"), lambda v: _verdict(v, kind.elementType)))
    elif name == "map":
        worst = _worst(F.transform(F.map_values(as_type("map<string,variant>")), lambda v: _verdict(v, kind.valueType)))
    elif name == "struct":
        fields = as_type("map<string,variant>")
        inner = [(F.try_element_at(fields, F.lit(f.name)), f.dataType) for f in kind]
        worst = _worst(F.array(*[F.when(v.isNull(), "type_mismatch").otherwise(_verdict(v, t)) for v, t in inner]))
    found = F.when(seen == "VOID", "ok").when(~accepted, "type_mismatch")
    if name in (*INTEGERS, "decimal"):
        found = found.when(~fits, "out_of_range")
    return found.otherwise(F.lit("ok") if worst is None else worst)


def _worst(verdicts: Column) -> Column:
    has = lambda v: F.array_contains(verdicts, v)
    return F.when(has("type_mismatch"), "type_mismatch").when(has("out_of_range"), "out_of_range").otherwise("ok")


def _field_verdicts(contract: str) -> Column:
    """Verdicts from a payload's ``fields``: variants by name."""
    schema = T.StructType.fromDDL(contract)
    refuse_unknown(schema, "")
    fields, names = F.col("fields"), F.map_keys("fields")

    def one(f: T.StructField) -> Column:
        value = F.try_element_at(fields, F.lit(f.name))
        verdict = F.when(~F.array_contains(names, f.name), "missing").otherwise(_verdict(value, f.dataType))
        return F.struct(F.lit(f.name).alias("field"), verdict.alias("verdict"))

    declared = F.array(*[one(f) for f in schema])
    unknown = F.array_except(names, F.array(*[F.lit(n) for n in schema.names]))
    extra = F.transform(unknown, lambda n: F.struct(n.alias("field"), F.lit("extra").alias("verdict")))
    return F.when(fields.isNull(), _single("unreadable")).when(F.size(unknown) == 0, declared).otherwise(F.concat(declared, extra))


def _single(verdict: str) -> Column:
    return F.array(F.struct(F.lit("*").alias("field"), F.lit(verdict).alias("verdict")))


def with_verdicts(payloads: DataFrame, contracts: Mapping[str, str]) -> DataFrame:
    """Payload rows (``subject``, ``value``) with ``verdicts``, an array of (field, verdict).

    Verdicts: ``ok`` (also for NULL), ``missing``, ``type_mismatch``, ``out_of_range`` for a number that the type does
    not hold, ``extra``; a payload that is no JSON object gives ``unreadable`` for the field ``*``. Structs, arrays and
    maps are judged with all that is in them; of a struct every field must be there. A contract binds its own subject only;
    a subject without one is ``unchecked``, not ``ok``. Each payload is parsed once.
    """
    bound = [(F.col("subject") == subject, contract) for subject, contract in contracts.items()]
    return _judged(payloads, bound)


def _judged(payloads: DataFrame, bound: list[tuple[Column, str]]) -> DataFrame:
    """Verdicts by the contract whose condition holds; conditions exclude each other."""
    any_bound = reduce(lambda x, y: x | y, [F.coalesce(c, F.lit(False)) for c, _ in bound], F.lit(False))
    checked = F.when(~any_bound, _single("unchecked"))
    for condition, contract in bound:
        checked = checked.when(condition, _field_verdicts(contract))
    parsed = F.try_variant_get(F.try_parse_json("value"), "$", "map<string,variant>")
    # the generator keeps the parsed payload a column: inlined, it would be parsed for each field
    once = payloads.withColumn("fields", F.explode(F.array(F.when(any_bound, parsed))))
    return once.withColumn("verdicts", checked).drop("fields")


def versioned_conformance(payloads: DataFrame, registry: DataFrame, width: int) -> DataFrame:
    """Events per subject, contract version, field and verdict, each judged by the version valid at its ``position``.

    ``payloads`` has ``subject, position, value``. Events before a subject's first version are ``unchecked``, with a
    NULL version. ``width`` is the stretch of positions that are sorted together (:func:`asof_join`). The registry's rows, one per
    contract version, are read by the driver, which builds their checks.
    """
    found = asof_join(payloads.select("subject", "position", "value"), registry, "subject", "position", "valid_from", ["version"], width)
    rows = registry.select("subject", "version", "contract").collect()
    bound = [((F.col("subject") == r.subject) & (F.col("version") == r.version), r.contract) for r in rows]
    return _counted(_judged(found, bound), "subject", "version")


def conformance(payloads: DataFrame, contracts: Mapping[str, str]) -> DataFrame:
    """Events per subject, field and verdict.

    Events are first counted by their whole set of verdicts, of which there are few, so fields are
    unfolded for those sets and not for every event.
    """
    return _counted(with_verdicts(payloads, contracts), "subject")


def _counted(judged: DataFrame, *by: str) -> DataFrame:
    return (
        judged.groupBy(*by, "verdicts")
        .agg(F.count("*").alias("events"))
        # never empty; the plain form would push a size test, and with it the verdicts, below the count
        .select(*by, "events", F.inline_outer("verdicts"))
        .groupBy(*by, "field", "verdict")
        .agg(F.sum("events").alias("n"))
    )


def quarantine(payloads: DataFrame, contracts: Mapping[str, str]) -> DataFrame:
    """Payload rows with ``verdict`` accepted or quarantined and the first field at fault, else ``*``.

    An extra field can be ignored by a reader and does not keep an event out.
    """
    fault = F.filter("verdicts", lambda v: v.verdict.isin("missing", "type_mismatch", "out_of_range", "unreadable"))
    return (
        with_verdicts(payloads, contracts)
        .withColumn("fault", F.try_element_at(fault, F.lit(1)))
        .select(
            *payloads.columns,
            F.when(F.col("fault").isNull(), "accepted").otherwise("quarantined").alias("verdict"),
            F.coalesce("fault.field", F.lit("*")).alias("field"),
        )
    )
