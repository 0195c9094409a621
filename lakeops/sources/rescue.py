"""Rescue column for semi-structured records.

A document's JSON text is parsed once, into a VARIANT, and everything is read
from that value: the declared fields with their types, at any depth, and the
difference to the declared schema. Kept in a JSON string column instead of
being lost: fields that the schema does not know, at any depth (inside declared
structs, arrays and maps too; case variants count as unknown, field matching is
case-sensitive), known fields whose value did not fit the declared type, and
records that are no JSON object at all (under ``_value``; so is text that is no
JSON, or repeats a name within an object):

    {"data": [{"<field>": "<value's text>"}], "_file_path": "<source file>"}

A value's text is its JSON, a string's its characters. A nested rest is the
JSON text of its own such object (for arrays: an array with a null where an
element has no rest). ``root`` names the path from the document root (``data``
for records that came from the envelope's ``data`` array; None for a top-level
document); ``outer`` holds the rest of the levels above, such as unknown
envelope fields. Recovery is ordinary JSON navigation (``recover_field``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def fields_of(v: Column) -> Column:
    """An object's fields: map<string,variant>, null for any other value."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def text_of(v: Column) -> Column:
    """A value's JSON text, a string's characters; null for a JSON null."""
    return F.try_variant_get(v, "$", "string")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _scalar(v: Column, kind: T.DataType) -> Column:
    """The value if it is of the kind: no text for a number, no fraction for a whole one."""
    if isinstance(kind, T.StringType):
        return text_of(v)
    value, json = F.try_variant_get(v, "$", kind.simpleString()), F.to_json(v)
    if isinstance(kind, T.IntegralType):
        return F.when(json.rlike("^-?[0-9]+$"), value)
    if isinstance(kind, T.NumericType):
        return F.when(json.rlike("^-?[0-9]"), value)
    if isinstance(kind, T.BooleanType):
        return F.when(json.isin("true", "false"), value)
    return F.when(json.startswith('"'), value) if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)) else value


def _reading(v: Column, kind: T.DataType) -> Column:
    """struct<value, rest>: the typed value, and the text of what the type
    does not take (null if nothing is left)."""
    there = v.isNotNull() & ~F.is_variant_null(v)
    if isinstance(kind, T.StructType):
        def read(m: Column) -> Column:
            return _bound(read_fields(m, kind), lambda r: F.struct(
                F.when(m.isNotNull(), r["value"]).alias("value"),
                F.when(m.isNull() & there, text_of(v)).otherwise(F.when(F.size(r["rest"]) > 0, F.to_json(r["rest"]))).alias("rest")))
        return _bound(fields_of(v), read)
    if isinstance(kind, T.ArrayType):
        def each(e: Column) -> Column:
            return _bound(F.transform(e, lambda x: _reading(x, kind.elementType)), lambda rs: F.struct(
                F.transform(rs, lambda r: r["value"]).alias("value"),
                F.when(e.isNull() & there, text_of(v)).otherwise(
                    F.when(F.exists(rs, lambda r: r["rest"].isNotNull()), F.to_json(F.transform(rs, lambda r: r["rest"])))).alias("rest")))
        return _bound(F.try_variant_get(v, "$", "array<variant>"), each)
    if isinstance(kind, T.MapType):
        def entries(m: Column) -> Column:
            return _bound(F.transform_values(m, lambda k, x: _reading(x, kind.valueType)), lambda rs: _bound(
                F.map_filter(F.transform_values(rs, lambda k, r: r["rest"]), lambda k, t: t.isNotNull()), lambda rest: F.struct(
                    F.transform_values(rs, lambda k, r: r["value"]).alias("value"),
                    F.when(m.isNull() & there, text_of(v)).otherwise(F.when(F.size(rest) > 0, F.to_json(rest))).alias("rest"))))
        return _bound(fields_of(v), entries)
    return _bound(_scalar(v, kind), lambda value: F.struct(value.alias("value"), F.when(there & value.isNull(), text_of(v)).alias("rest")))


def read_fields(fields: Column, schema: T.StructType) -> Column:
    """struct<value, rest> of an object's fields: the typed struct, and by name
    the text of what the schema does not take (map<string,string>)."""
    names = F.array(*(F.lit(n) for n in schema.names)).cast("array<string>")
    unknown = F.transform_values(F.map_filter(fields, lambda k, v: ~F.array_contains(names, k)), lambda k, v: text_of(v))
    if not schema.fields:
        return F.struct(F.struct().alias("value"), unknown.alias("rest"))
    read = F.struct(*(_reading(F.try_element_at(fields, F.lit(f.name)), f.dataType).alias(f"f{i}") for i, f in enumerate(schema.fields)))

    def made(r: Column) -> Column:
        left = F.array(*(F.struct(F.lit(f.name).alias("k"), r[f"f{i}"]["rest"].alias("v")) for i, f in enumerate(schema.fields)))
        known = F.map_from_entries(F.filter(left, lambda e: e["v"].isNotNull()))
        return F.struct(F.struct(*(r[f"f{i}"]["value"].alias(f.name) for i, f in enumerate(schema.fields))).alias("value"),
                        F.map_concat(unknown, known).alias("rest"))

    return _bound(read, made)


def rescued_record(v: Column, schema: T.StructType, text: Column | None = None, file_path: Column | None = None,
                   root: str | None = None, outer: Column | None = None) -> Column:
    """struct<value, rescued> of a parsed record: the typed struct (null if it
    is no object) and the rescue column's JSON (null if nothing is left).
    ``text`` is the record's own text, for one that is no JSON (null value)."""
    text = text if text is not None else F.to_json(v)

    def made(m: Column) -> Column:
        return _bound(read_fields(m, schema), lambda r: F.struct(F.when(m.isNotNull(), r["value"]).alias("value"), _payload(F.when(
            m.isNotNull(), r["rest"]).otherwise(F.when(text.isNotNull(), F.create_map(F.lit("_value"), text)))).alias("rescued")))

    def _payload(rest: Column) -> Column:
        parts = [(F.array(rest) if root else rest).alias(root or "fields")]
        if outer is not None:
            parts.append(F.when(F.size(outer) > 0, outer).alias("_envelope"))
        if file_path is not None:
            parts.append(file_path.alias("_file_path"))
        json = F.to_json(F.struct(*parts)) if len(parts) > 1 or root else F.to_json(rest)
        found = F.size(rest) > 0
        return F.when(found if outer is None else found | (F.size(outer) > 0), json)

    return _bound(fields_of(v), made)


def parse_with_rescue(text: Column, schema: T.StructType, file_path: Column | None = None,
                      root: str | None = None, outer: Column | None = None) -> tuple[Column, Column]:
    """Return (typed struct, rescued JSON or null) of a record's text."""
    record = _bound(F.try_parse_json(text), lambda v: rescued_record(v, schema, text, file_path, root, outer))
    return record["value"], record["rescued"]


def recover_field(rescued: Column, field: str, dtype: str = "string", root: str | None = "data") -> Column:
    """Read one rescued field back, e.g. ``data[0].field``, cast to ``dtype``."""
    if root:
        parsed = F.from_json(rescued, f"struct<{root}: array<map<string,string>>>")
        value = F.element_at(parsed[root], 1)[field]
    else:
        value = F.from_json(rescued, "map<string,string>")[field]
    return value.cast(dtype)
