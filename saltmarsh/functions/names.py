"""Field names of nested data, cleaned of characters that tables don't take."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: the characters that stay; each other one becomes an underscore.
OTHERS = "[^A-Za-z0-9_]"


def clean(name: str) -> str:
    return re.sub(OTHERS, "_", name)


def clean_type(t: T.DataType) -> T.DataType:
    """The type with clean field names at every depth. Raises if two fields become one."""
    if isinstance(t, T.StructType):
        names = [clean(f.name) for f in t.fields]
        if len({n.lower() for n in names}) < len(names):
            raise ValueError(f"fields collide after cleaning: {[f.name for f in t.fields]}")
        return T.StructType([T.StructField(n, clean_type(f.dataType), f.nullable) for n, f in zip(names, t.fields, strict=True)])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(clean_type(t.elementType), t.containsNull)
    if isinstance(t, T.MapType):
        return T.MapType(t.keyType, clean_type(t.valueType), t.valueContainsNull)
    return t


def _clean_keys(c: Column, t: T.DataType) -> Column:
    """c, of a type with clean names, with the keys of all its string maps cleaned, at every depth."""
    if isinstance(t, T.StructType) and _has_map(t):
        return F.when(c.isNotNull(), F.struct(*[_clean_keys(c[f.name], f.dataType).alias(f.name) for f in t.fields]))
    if isinstance(t, T.ArrayType) and _has_map(t):
        return F.transform(c, lambda x: _clean_keys(x, t.elementType))
    if isinstance(t, T.MapType):
        values = F.transform_values(c, lambda _, v: _clean_keys(v, t.valueType)) if _has_map(t.valueType) else c
        return F.transform_keys(values, lambda k, _: F.regexp_replace(k, OTHERS, "_")) if isinstance(t.keyType, T.StringType) else values
    return c


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.StructType):
        return any(_has_map(f.dataType) for f in t.fields)
    return isinstance(t, T.MapType) or isinstance(t, T.ArrayType) and _has_map(t.elementType)


def sanitize(df: DataFrame) -> DataFrame:
    """df with clean names through structs, arrays and maps; keys of string maps are cleaned too, at every depth."""
    new = clean_type(df.schema)
    columns = [(F.col(f"`{old.name}`").cast(f.dataType), f) for old, f in zip(df.schema.fields, new.fields, strict=True)]
    return df.select(*[_clean_keys(c, f.dataType).alias(f.name) for c, f in columns])


# A JSON string, without going back: a value of any length takes no stack.
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _clean_keys_of(c: Column) -> Column:
    """JSON text with its keys cleaned. A key is a string that a colon follows; strings are matched whole, so nothing inside one is taken for a key."""
    parts = F.regexp_extract_all(c, F.lit(rf'(?s)({_STRING}\s*+:|{_STRING}|[^"]++)'), F.lit(1))
    quoted = lambda x: F.regexp_replace(x, r"\s*+:$", "")
    # What is escaped in a key counts as what it stands for.
    plain = lambda x: F.when(x.contains("\\"), F.get_json_object(F.concat(F.lit("["), quoted(x), F.lit("]")), "$[0]")).otherwise(F.regexp_replace(quoted(x), '^"|"$', ""))
    key = lambda x: F.concat(F.lit('"'), F.regexp_replace(plain(x), OTHERS, "_"), F.lit('":'))
    return F.array_join(F.transform(parts, lambda x: F.when(x.endswith(":") & x.startswith('"'), key(x)).otherwise(x)), "")


def _whole_json(c: Column) -> Column:
    """Whether the parser takes the text; single quotes, which it would also take for strings, aren't JSON."""
    return F.get_json_object(c, "$").isNotNull() & ~F.regexp_replace(c, _STRING, "").contains("'")


def sanitize_variant(c: Column) -> Column:
    """JSON text as VARIANT with the keys of all its objects cleaned. Raises if two keys of an object become one, or for text that isn't JSON."""
    return F.parse_json(_clean_keys_of(c))


def sanitize_json(c: Column, strict: bool = False) -> Column:
    """JSON text with the keys of all its objects cleaned, whatever their depth (up to 1,000); values stay as they are written.

    NULL stays NULL. Text that isn't JSON (a string that doesn't end, a bracket too few) is NULL, or raises where strict.
    Two keys of an object that are equal, or become so, raise. What stands behind the end of the value isn't looked at.
    """
    cleaned = _clean_keys_of(c)
    broken = F.raise_error(F.concat(F.lit("not JSON: "), F.substring(c, 1, 100))).cast("string") if strict else F.lit(None).cast("string")
    return F.when(~_whole_json(c), broken).when(F.parse_json(cleaned).isNotNull(), cleaned)
