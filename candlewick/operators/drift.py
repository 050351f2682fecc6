"""What landed JSON holds beside or against its declared schema."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNREADABLE = "UNREADABLE"
_PAIRS = "array<struct<path: string, value: variant>>"


def declared_types(schema: T.StructType, prefix: str = "") -> Iterator[tuple[str, T.DataType]]:
    """(path, type) of every field at any depth; ``[]`` stands for the elements of an array."""
    for field in schema:
        path, kind = f"{prefix}{field.name}", field.dataType
        yield path, kind
        while isinstance(kind, T.ArrayType):
            path, kind = f"{path}[]", kind.elementType
            yield path, kind
        if isinstance(kind, T.StructType):
            yield from declared_types(kind, f"{path}.")


def _pairs(array: Column, make: Callable[[Column], Column]) -> Column:
    """make(element) for each element; nothing for a NULL array."""
    return F.coalesce(F.transform(array, make), F.array().cast(_PAIRS))


def _pair(path: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), value.alias("value"))


def _values(value: Column, kind: T.DataType, path: str) -> Column:
    """(path, value) pairs of all that lies below a value of a declared type, as one array."""
    if isinstance(kind, T.ArrayType):
        elements = value.try_cast("array<variant>")
        below = F.transform(elements, lambda e: _values(e, kind.elementType, f"{path}[]"))
        return F.concat(
            _pairs(elements, lambda e: _pair(F.lit(f"{path}[]"), e)),
            F.coalesce(F.flatten(below), F.array().cast(_PAIRS)),
        )
    if not isinstance(kind, T.StructType):
        return F.array().cast(_PAIRS)
    prefix = f"{path}." if path else ""
    fields = value.try_cast("map<string, variant>")
    own = _pairs(F.map_entries(fields), lambda e: _pair(F.concat(F.lit(prefix), e["key"]), e["value"]))
    nested = [f for f in kind if isinstance(f.dataType, (T.StructType, T.ArrayType))]
    return F.concat(own, *[_values(F.try_element_at(fields, F.lit(f.name)), f.dataType, f"{prefix}{f.name}") for f in nested])


def unfold(lines: DataFrame, schema: T.StructType, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """(*keep, path, declared, landed, value): one row per value of each JSON line, at every level that the schema
    describes; ``value`` is a VARIANT, ``landed`` its JSON type and ``declared`` the type of the schema, or NULL.

    A line is parsed once and unfolded by one generator: no join and no shuffle. A value below a field that the
    schema lacks stays inside that field's value. Blank lines have no rows; a line that is not one JSON object, or
    names a field twice, is a single row ``$`` of type UNREADABLE. A NULL element or field has the type VOID.
    """
    types = dict(declared_types(schema))
    text = F.col(value)
    parsed = lines.where(F.length(F.trim(text)) > 0).select(*keep, F.try_parse_json(text).alias("_line"))
    is_object = F.col("_line").try_cast("map<string, variant>").isNotNull()
    alone = F.array(_pair(F.lit("$"), F.lit(None).cast("variant"))).cast(_PAIRS)
    rows = parsed.select(*keep, F.explode(F.when(is_object, _values(F.col("_line"), schema, "")).otherwise(alone)).alias("_at"))
    found = F.col("_at.value")
    kind = F.regexp_extract(F.schema_of_variant(found), "^[A-Z]+", 0)
    known = F.create_map(*[F.lit(x) for path, t in types.items() for x in (path, t.simpleString())])
    return rows.select(
        *keep,
        F.col("_at.path").alias("path"),
        F.try_element_at(known, F.col("_at.path")).alias("declared"),
        F.when(F.col("_at.path") == "$", UNREADABLE).when(found.isNull(), "VOID").otherwise(kind).alias("landed"),
        found.alias("value"),
    )


def _taken(schema: T.StructType) -> Column:
    """Whether the JSON reader keeps a value: it must be of its container's kind, or the reader's own rules, asked
    with the value alone, must give something. Text takes any value."""
    kinds = {t.simpleString(): t for _, t in declared_types(schema)}
    taken = F.when(F.col("landed") == "VOID", True)
    for name, kind in kinds.items():
        here = F.col("declared") == name
        if isinstance(kind, T.StructType):
            taken = taken.when(here, F.col("landed") == "OBJECT")
        elif isinstance(kind, T.ArrayType):
            taken = taken.when(here, F.col("landed") == "ARRAY")
        elif not isinstance(kind, T.StringType):
            alone = F.concat(F.lit('{"v":'), F.to_json("value"), F.lit("}"))
            taken = taken.when(here, F.from_json(alone, f"v {name}").getField("v").isNotNull())
    return taken.otherwise(True)


def drift_report(unfolded: DataFrame, schema: T.StructType) -> DataFrame:
    """path, declared, landed, n_values, n_lost, status per kind of value. ``status`` is ``unknown`` for a field that
    the schema lacks, ``lost`` where values become NULL, else ``ok``; counts are summed before they are shuffled."""
    lost = (F.col("landed") == UNREADABLE) | (F.col("declared").isNotNull() & ~_taken(schema))
    counted = unfolded.groupBy("path", "declared", "landed").agg(
        F.count(F.lit(1)).alias("n_values"), F.count_if(lost).alias("n_lost")
    )
    status = (
        F.when(F.col("n_lost") > 0, "lost").when(F.col("declared").isNull(), "unknown").otherwise("ok").alias("status")
    )
    return counted.select("*", status)


def unknown_values(unfolded: DataFrame) -> DataFrame:
    """The values of fields that the schema lacks, kept as VARIANT."""
    return unfolded.where(F.col("declared").isNull() & (F.col("landed") != UNREADABLE)).drop("declared")
