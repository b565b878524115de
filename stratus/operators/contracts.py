"""Data contracts over raw JSON, compiled to column expressions.

A contract is a tree of named fields. It is walked once on the driver and
becomes one array expression of error texts, so checking is a projection: no
shuffle, no Python per row, the same on batch and stream.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.functions import epoch_micros


@dataclass(frozen=True)
class Field:
    name: str
    type: str | None = None
    required: bool = False
    fields: tuple[Field, ...] = ()


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    max_age_minutes: float | None = None


def _required(name: str, kind: str, *fields: Field) -> Field:
    return Field(name, kind, True, fields)


def _optional(name: str, kind: str, *fields: Field) -> Field:
    return Field(name, kind, False, fields)


# The two payload contracts.
CURRENT_CONTRACT = Contract(
    "weather_current",
    (
        _required(
            "main", "object",
            _required("temp", "number"), _optional("feels_like", "number"),
            _required("humidity", "integer"), _required("pressure", "integer"),
            _optional("temp_min", "number"), _optional("temp_max", "number"),
        ),
        _required("wind", "object", _required("speed", "number"), _optional("deg", "integer")),
        _required("weather", "array"),
        _required("name", "string"),
        _required("dt", "integer"),
        _required("coord", "object", _required("lon", "number"), _required("lat", "number")),
        _optional("sys", "object"),
    ),
    max_age_minutes=360,
)
FORECAST_CONTRACT = Contract(
    "weather_forecast",
    (
        _required("list", "array"),
        _required("city", "object", _required("name", "string"), _required("coord", "object")),
        _required("cnt", "integer"),
    ),
    max_age_minutes=360,
)

# Shape of a JSON value to the kind name used in messages; every other shape is a float.
KIND_NAMES = {
    "OBJECT": "dict", "ARRAY": "list", "STRING": "str", "BIGINT": "int", "BOOLEAN": "bool", "VOID": "NoneType",
}
FLOAT_SHAPES = ("DOUBLE", "DECIMAL", "FLOAT")
# Which shapes satisfy a declared type. A boolean counts as a whole number.
ACCEPTED = {
    "string": ("STRING",),
    "integer": ("BIGINT", "BOOLEAN"),
    "number": ("BIGINT", "BOOLEAN", *FLOAT_SHAPES),
    "boolean": ("BOOLEAN",),
    "array": ("ARRAY",),
    "object": ("OBJECT",),
}


def contract_from_dict(document: dict[str, Any]) -> Contract:
    """Build a contract from a parsed YAML or JSON document."""
    body = document["contract"]

    def field(spec: dict[str, Any]) -> Field:
        return Field(
            spec["name"], spec.get("type"), bool(spec.get("required", False)),
            tuple(field(child) for child in spec.get("fields", ())),
        )

    age = (body.get("freshness") or {}).get("max_age_minutes")
    return Contract(body["name"], tuple(field(f) for f in body["schema"]["fields"]), age)


def load_contract(path: str | Path) -> Contract:
    import yaml

    with open(path) as handle:
        return contract_from_dict(yaml.safe_load(handle))


def json_shape(value: Column) -> Column:
    """Outermost shape of a VARIANT value, such as ``OBJECT`` or ``BIGINT``; NULL when there is none."""
    full = F.schema_of_variant(value)
    return F.substring_index(F.substring_index(full, "<", 1), "(", 1)


def kind_name(shape: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in KIND_NAMES.items() for x in pair])
    return F.when(shape.isNotNull(), F.coalesce(F.try_element_at(names, shape), F.lit("float")))


@dataclass(frozen=True)
class _Node:
    """A field of the contract tree with its place in the flattened order."""

    spec: Field
    path: str
    shown: str
    parent: int | None


def _flatten(fields: tuple[Field, ...], nodes: list[_Node], path: str = "$", shown: str = "",
             parent: int | None = None) -> list[_Node]:
    for spec in fields:
        here = _Node(spec, f"{path}['{spec.name}']", f"{shown}.{spec.name}" if shown else spec.name, parent)
        nodes.append(here)
        if spec.type == "object" and spec.fields:
            _flatten(spec.fields, nodes, here.path, here.shown, len(nodes) - 1)
    return nodes


def _rule(i: int, node: _Node) -> Column:
    spec = node.spec
    mismatch = accepted = None
    if spec.type in ACCEPTED:
        mismatch = f"Type mismatch at {node.shown}: expected {spec.type}, got "
        accepted = list(ACCEPTED[spec.type])
    return F.struct(
        F.lit(i).alias("place"),
        F.lit(node.parent).cast("int").alias("parent"),
        F.lit(f"Missing required field: {node.shown}" if spec.required else None).cast("string").alias("missing"),
        F.lit(mismatch).cast("string").alias("mismatch"),
        F.lit(accepted).cast("array<string>").alias("accepted"),
    )


def _error(rule: Column) -> Column:
    shape = F.get("_shapes", rule["place"])
    # Below something that is not an object there is nothing to miss.
    reachable = rule["parent"].isNull() | F.get("_shapes", rule["parent"]).eqNullSafe(F.lit("OBJECT"))
    wrong = rule["mismatch"].isNotNull() & ~F.array_contains(rule["accepted"], shape)
    return F.when(shape.isNull(), F.when(reachable, rule["missing"])).when(
        wrong, F.concat(rule["mismatch"], kind_name(shape))
    )


def _plainly_fine(i: int, node: _Node) -> Column:
    """Field present in an accepted shape, or optional and absent."""
    shape, optional = F.get("_shapes", F.lit(i)), not node.spec.required
    if node.spec.type in ACCEPTED:
        return F.coalesce(shape.isin(*ACCEPTED[node.spec.type]), F.lit(optional))
    return F.lit(True) if optional else shape.isNotNull()


def check_contract(df: DataFrame, raw: str, contract: Contract) -> DataFrame:
    """Add ``malformed`` and ``contract_errors`` (in contract order); every row is kept.

    The text is parsed once and every field's shape is taken once. The rules
    are one constant array that is mapped to messages, so the generated code
    stays small enough to be compiled, however long the contract. The shapes
    pass through a one-row generator, which the optimizer does not see through:
    a later filter on the errors would otherwise repeat the parsing.
    """
    nodes = _flatten(contract.fields, [])
    shapes = F.array(*[json_shape(F.try_variant_get("_doc", node.path, "variant")) for node in nodes])
    parsed = df.withColumn("_doc", F.try_parse_json(raw)).select(
        *df.columns, F.inline(F.array(F.struct(F.col("_doc").isNull().alias("malformed"), shapes.alias("_shapes"))))
    )
    rules = F.array(*[_rule(i, node) for i, node in enumerate(nodes)])
    found = F.filter(F.transform(rules, lambda rule: _error(rule)), lambda error: error.isNotNull())
    # Most documents keep their contract; a chain of comparisons tells so without building messages.
    fine = reduce(lambda a, b: a & b, [_plainly_fine(i, node) for i, node in enumerate(nodes)])
    errors = F.when(fine, F.array().cast("array<string>")).otherwise(found)
    return parsed.withColumn("contract_errors", F.when(~F.col("malformed"), errors)).drop("_shapes")


def keeps_contract() -> Column:
    return ~F.col("malformed") & (F.size("contract_errors") == 0)


def split_quarantine(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that keep the contract, and rows that do not or did not parse.

    For large inputs write ``with_target`` once, partitioned by ``target``, and
    read the two folders: then the payloads are parsed only once.
    """
    return checked.where(keeps_contract()), checked.where(~keeps_contract())


def with_target(checked: DataFrame) -> DataFrame:
    """Name the folder a row belongs to: ``valid`` or ``quarantine``."""
    return checked.withColumn("target", F.when(keeps_contract(), "valid").otherwise("quarantine"))


def store_split(checked: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Write both sides in one pass and return them as reads of their folders."""
    with_target(checked).write.mode("append").partitionBy("target").parquet(path)
    stored = checked.sparkSession.read.schema(with_target(checked).schema).parquet(path)
    return stored.where(F.col("target") == "valid"), stored.where(F.col("target") == "quarantine")


def row_freshness(epoch_seconds: Column | str, contract: Contract, now: Column) -> Column:
    """True while the row's age is within the contract's limit; true without limit or time."""
    if contract.max_age_minutes is None:
        return F.lit(True)
    at = F.col(epoch_seconds) if isinstance(epoch_seconds, str) else epoch_seconds
    age_minutes = (epoch_micros(now) / F.lit(1e6) - at) / 60
    return F.coalesce(age_minutes <= F.lit(float(contract.max_age_minutes)), F.lit(True))
