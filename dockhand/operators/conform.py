"""Conform a frame to a target (P3-P7, P10).  All pure projections."""

from __future__ import annotations

from typing import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)
_INTEGRALS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by map; names not in the frame are ignored.

    Matching follows the session's case rule (insensitive by default).
    """
    return df.withColumnsRenamed(dict(mapping)) if mapping else df


def nan_to_null(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """P5: NaN becomes NULL in every float/double column (or the listed ones)."""
    targets = {f.name for f in df.schema.fields
               if isinstance(f.dataType, _FLOATS) and (columns is None or f.name in columns)}
    if not targets:
        return df
    return df.select(*[
        F.nanvl(_q(n), F.lit(None).cast(df.schema[n].dataType)).alias(n) if n in targets else _q(n)
        for n in df.columns])


def force_string(df: DataFrame, columns: list[str]) -> DataFrame:
    """Listed columns become text; NULL stays NULL."""
    wanted = set(columns)
    missing = wanted - set(df.columns)
    if missing:
        raise KeyError(f"force_string: no such columns {sorted(missing)}")
    return df.select(*[_q(n).cast("string").alias(n) if n in wanted else _q(n) for n in df.columns])


def _strict_cast(c: Column, name: str, src: T.DataType, dst: T.DataType) -> Column:
    """Cast that raises instead of producing NULL or silently truncating.

    ANSI casting already refuses text that is no number and overflow; this
    also refuses a fraction cast to an integral type (pandas' nullable
    integers refuse it too) and NaN into an integral type, independent of
    the session's ANSI flag.
    """
    out = c.try_cast(dst)
    bad = c.isNotNull() & out.isNull()
    if isinstance(dst, _INTEGRALS) and isinstance(src, (*_FLOATS, T.DecimalType)):
        bad = bad | (c.isNotNull() & (c != F.floor(c)))
    msg = F.concat(F.lit(f"cannot conform column {name} to {dst.simpleString()}: "), c.cast("string"))
    return F.when(bad, F.raise_error(msg).cast(dst)).otherwise(out)


def _by_name(struct: T.StructType, path: str, exact: bool) -> dict[str, T.StructField]:
    """Fields by folded name; two fields of one name would be a guess."""
    out: dict[str, T.StructField] = {}
    for f in struct.fields:
        key = f.name if exact else f.name.lower()
        if key in out:
            raise KeyError(f"{path}: field name {f.name} is ambiguous")
        out[key] = f
    return out


def conform_value(c: Column, path: str, src: T.DataType, dst: T.DataType, *, strict: bool = True,
                  fill_missing: bool = False, refuse_extra: bool = False, exact: bool = False) -> Column:
    """``c`` of type ``src`` as a value of type ``dst``, nested fields matched by name.

    Structs are rebuilt field by field in the target's order, inside arrays,
    map keys and map values as well; only leaves are cast.  A field that the source lacks
    is an error, or NULL with ``fill_missing``; a field that the target lacks
    is dropped, or an error with ``refuse_extra``.  A NULL struct, array or map
    stays NULL.  One expression, no Python, no shuffle.
    """
    rest = {"strict": strict, "fill_missing": fill_missing, "refuse_extra": refuse_extra, "exact": exact}
    if src == dst or isinstance(src, T.NullType):
        return c.cast(dst) if isinstance(src, T.NullType) else c
    if isinstance(src, T.StructType) and isinstance(dst, T.StructType):
        have = _by_name(src, path, exact)
        want = _by_name(dst, path, exact)
        missing = [f.name for k, f in want.items() if k not in have]
        extra = [f.name for k, f in have.items() if k not in want]
        if missing and not fill_missing:
            raise KeyError(f"{path}: source lacks nested fields {missing}")
        if extra and refuse_extra:
            raise KeyError(f"{path}: target lacks nested fields {extra}")
        fields = []
        for k, f in want.items():
            inner = (conform_value(c.getField(have[k].name), f"{path}.{f.name}", have[k].dataType, f.dataType, **rest)
                     if k in have else F.lit(None).cast(f.dataType))
            fields.append(inner.alias(f.name))
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(src, T.ArrayType) and isinstance(dst, T.ArrayType):
        return F.transform(c, lambda x: conform_value(x, f"{path}[]", src.elementType, dst.elementType, **rest))
    if isinstance(src, T.MapType) and isinstance(dst, T.MapType):
        if src.keyType != dst.keyType:
            c = F.transform_keys(c, lambda k, _: conform_value(k, f"{path}.key", src.keyType, dst.keyType, **rest))
        if src.valueType != dst.valueType:
            c = F.transform_values(c, lambda _, v: conform_value(v, f"{path}.value", src.valueType, dst.valueType, **rest))
        return c
    return _strict_cast(c, path, src, dst) if strict else c.try_cast(dst)


def matches_case(spark: SparkSession) -> bool:
    """The session's case rule: True if names must agree in case."""
    return spark.conf.get("spark.sql.caseSensitive", "false").lower() == "true"


def conform_schema(df: DataFrame, target: T.StructType, strict: bool = True,
                   keep_extra: bool = True, fill_missing: bool = False) -> DataFrame:
    """Cast each target column to its declared type, nested fields by name.

    A target column (or nested field) missing from the frame is an error, or
    NULL with ``fill_missing``.  Extra columns are kept (``keep_extra``) in place; extra nested fields are
    dropped, the declared type has no room for them.  ``strict`` raises on
    any value that does not fit; lenient mode gives NULL.  Types are never
    widened to text (the staging type is the declared type).
    """
    have = {n.lower(): n for n in df.columns}
    missing = [f for f in target.fields if f.name.lower() not in have]
    if missing and not fill_missing:
        raise KeyError(f"conform_schema: frame lacks target columns {[f.name for f in missing]}")
    tmap = {f.name.lower(): f for f in target.fields}
    exact = matches_case(df.sparkSession)
    cols = []
    for n in df.columns:
        f = tmap.get(n.lower())
        if f is None:
            if keep_extra:
                cols.append(_q(n))
            continue
        cols.append(conform_value(_q(n), n, df.schema[n].dataType, f.dataType, strict=strict, fill_missing=fill_missing,
                                  exact=exact).alias(f.name))
    return df.select(*cols, *(F.lit(None).cast(f.dataType).alias(f.name) for f in missing))


def parse_and_drop(df: DataFrame, parser: Callable[[DataFrame], Column],
                   keep: list[str] | None = None) -> DataFrame:
    """Map each row to a struct (or NULL) and drop the NULLs.

    ``parser`` receives the frame and returns a struct Column that is NULL
    for records to drop; the struct's fields become the output columns.
    """
    rec = parser(df)
    base = [_q(k) for k in (keep or [])]
    return df.select(*base, rec.alias("__rec")).where(F.col("__rec").isNotNull()).select(*base, "__rec.*")


def keep_where_not(df: DataFrame, predicate: Column | str) -> DataFrame:
    """P10: rows a SQL ``DELETE ... WHERE predicate`` would leave.

    DELETE removes rows where the predicate is TRUE only, so a NULL outcome
    keeps the row.
    """
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(p, F.lit(False)))
