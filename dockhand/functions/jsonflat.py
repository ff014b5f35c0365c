"""JSON flatten (F10) as one projection.

The schema is either given or inferred once over the whole column with
``schema_of_variant_agg`` (a distributed aggregate that merges per-partition
schemas; no row reaches the driver).  The driver then walks the schema and
emits one flat ``select``: nested keys are joined with ``sep`` and normalised
at every level, top-level scalar names are left as they are, lists stay
lists, an empty object yields no column.  Two paths landing on the same name
raise (Spark cannot reproduce "later key wins" on a schema).  Records that are
no object (``5``, ``[1]``) take no part in the inference; strict flattening raises on
them, lenient gives NULLs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _identity(name: str) -> str:
    return name


def _is_object(text: Column) -> Column:
    return text.rlike(r"^\s*\{")


def infer_json_schema(df: DataFrame, col: str) -> T.StructType:
    """Merged schema of a JSON text column's objects, computed on the executors
    over every row.  Mixed types in one field come back as ``variant``."""
    src = df.where(_is_object(F.col(col))).select(F.try_parse_json(F.col(col)).alias("v")).where(F.col("v").isNotNull())
    ddl = src.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if ddl is None or not ddl.startswith("OBJECT<"):
        return T.StructType([])
    # Variant schema text uses OBJECT<...> where a struct type string has STRUCT<...>.
    struct_ddl = ddl.replace("OBJECT<", "STRUCT<")
    probe = df.sparkSession.range(0).select(
        F.from_json(F.lit(None).cast("string"), struct_ddl).alias("x"))
    return probe.schema["x"].dataType


def leaf_paths(schema: T.StructType) -> Iterator[tuple[tuple[int, ...], tuple[str, ...], T.DataType]]:
    """(positions, names, type) of every leaf of a schema; an empty object has none."""
    todo = [((k,), (f.name,), f.dataType) for k, f in reversed(list(enumerate(schema.fields)))]
    while todo:
        at, names, kind = todo.pop()
        if isinstance(kind, T.StructType):
            todo += [((*at, k), (*names, f.name), f.dataType) for k, f in reversed(list(enumerate(kind.fields)))]
        else:
            yield at, names, kind


def column_name(path: tuple[str, ...], col_normalize: Callable[[str], str], sep: str) -> str:
    """Name of a leaf: its keys joined by ``sep``; from the second level on, the
    name so far and the next key are normalised before they are joined."""
    name = path[0]
    for key in path[1:]:
        name = f"{col_normalize(name)}{sep}{col_normalize(key)}"
    return name


def _by_position(schema: T.StructType) -> T.StructType:
    """The same structs with fields named by position, so that keys which differ only in case stay apart."""
    return T.StructType([T.StructField(f"f{k}", _by_position(f.dataType) if isinstance(f.dataType, T.StructType) else f.dataType)
                         for k, f in enumerate(schema.fields)])


def flat_columns(schema: T.StructType, root: Column,
                 col_normalize: Callable[[str], str] = _identity, sep: str = "_") -> list[Column]:
    """Projection list flattening ``root`` (a struct column of ``schema``, fields named by position)."""
    out: dict[str, Column] = {}
    for at, names, kind in leaf_paths(schema):
        name = column_name(names, col_normalize, sep)
        if name in out:
            raise ValueError(f"flattened name clash on {name!r}")
        value = root
        for k in at:
            value = value.getField(f"f{k}")
        # mixed types in one field: keep the text of the value
        out[name] = (F.try_variant_get(value, "$", "string") if isinstance(kind, T.VariantType) else value).alias(name)
    return list(out.values())


def json_flatten(df: DataFrame, col: str, schema: T.StructType | None = None,
                 col_normalize: Callable[[str], str] | None = None, sep: str = "_",
                 keep: list[str] | None = None, strict: bool = False) -> DataFrame:
    """Flatten a JSON text column into columns (plus the ``keep`` columns).

    ``col_normalize`` (identity by default; ``snake_case_name`` is the usual
    choice) is applied to every nested path at every level.  Without a
    ``schema`` the column is parsed twice, once to infer it: give one when it is known.

    ``strict`` raises on text that is no JSON object (the reference's
    behaviour); otherwise such text gives NULL in every flattened column.
    """
    if schema is None:
        schema = infer_json_schema(df, col)
    text = F.col(col)
    parsed = F.from_json(text, schema, {"mode": "FAILFAST" if strict else "PERMISSIVE"})
    other = F.raise_error(F.concat(F.lit("not a JSON object: "), text)).cast(schema) if strict else F.lit(None).cast(schema)
    parsed = F.when(text.isNull() | _is_object(text), parsed).otherwise(other).cast(_by_position(schema))
    cols = flat_columns(schema, F.col("__js"), col_normalize or _identity, sep)
    base = [F.col(f"`{k}`") for k in (keep or [])]
    return df.select(*base, parsed.alias("__js")).select(*base, *cols)


MAX_DEPTH = 8  # levels of objects that json_flatten_map opens


def _entries(text: Column, prefix: Column | None, normalize: Callable[[Column], Column], sep: str) -> Column:
    """An object's entries in the order of its text: (name, value as text, whether that is an object)."""
    def entry(raw: Column, typed: Column) -> Column:
        key = raw.getField("key")
        name = key if prefix is None else F.concat(normalize(prefix), F.lit(sep), normalize(key))
        # a text that looks like an object may be a string: only the typed value tells
        is_object = F.coalesce(F.schema_of_variant(typed.getField("value")).startswith("OBJECT"), F.lit(False))
        return F.struct(name.alias("name"), raw.getField("value").alias("value"), is_object.alias("object"))

    found = F.zip_with(F.map_entries(F.from_json(text, "map<string,string>")), F.map_entries(F.from_json(text, "map<string,variant>")), entry)
    return F.coalesce(found, F.array().cast("array<struct<name:string,value:string,object:boolean>>"))


def json_flatten_map(df: DataFrame, col: str, normalize: Callable[[Column], Column] | None = None, sep: str = "_",
                     keep: list[str] | None = None, name: str = "flat", strict: bool = False, max_depth: int = MAX_DEPTH) -> DataFrame:
    """F10 without a schema: a JSON text column as one ``map<string,string>`` of flat names to values.

    No pass over the data infers a schema, and keys that differ from row to row do not
    widen the table.  Names are made as in ``json_flatten``, by a Column function
    (``snake_case``).  Where several paths give one name, the later one in the
    text wins.  Scalars are given as text, lists as JSON text, null as NULL; an empty object
    gives no entry; a key that repeats within an object counts each time.

    One expression per row: objects are opened in place, level by level, so the
    order of the text is kept and nothing is shuffled.  Objects nested deeper than ``max_depth`` raise.
    Text that is no JSON object gives a NULL map, or raises if ``strict``.
    """
    normalize = normalize or (lambda c: c)
    text, base = F.col(col), [F.col(f"`{k}`") for k in (keep or [])]
    level = _entries(text, None, normalize, sep)
    for _ in range(max_depth - 1):
        level = F.flatten(F.transform(level, lambda e: F.when(
            e.getField("object"), _entries(e.getField("value"), e.getField("name"), normalize, sep)).otherwise(F.array(e))))
    deep = F.lit(f"json_flatten_map: objects nested deeper than {max_depth} levels at ")
    # by name, then by place in the text: of equal names the last one stays
    placed = F.array_sort(F.transform(level, lambda e, i: F.struct(
        F.when(e.getField("object") & (F.size(F.json_object_keys(e.getField("value"))) > 0), F.raise_error(F.concat(deep, e.getField("name"))).cast("string"))
        .otherwise(e.getField("name")).alias("name"), i.alias("at"), e.getField("value").alias("value"), e.getField("object").alias("object"))))
    is_object = _is_object(text) & F.try_parse_json(text).isNotNull()
    other = F.raise_error(F.concat(F.lit("not a JSON object: "), text)).cast("map<string,string>") if strict else F.lit(None).cast("map<string,string>")
    rows = df.select(*base, text.alias("__text"), is_object.alias("__ok"), placed.alias("__e"))
    nearest = F.filter("__e", lambda e, i: ~e.getField("object") & F.coalesce(F.get("__e", i + 1).getField("name") != e.getField("name"), F.lit(True)))
    flat = F.map_from_entries(F.transform(nearest, lambda e: F.struct(e.getField("name"), e.getField("value"))))
    text = F.col("__text")
    return rows.select(*base, F.when(text.isNull(), F.lit(None).cast("map<string,string>")).when(F.col("__ok"), flat).otherwise(other).alias(name))
