import decimal
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from dockhand.operators.conform import (conform_schema, force_string, keep_where_not, nan_to_null,
                                        parse_and_drop, rename_columns)


def test_rename_ignores_unknown_and_matches_case_insensitively(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, {"A": "x", "nope": "y"}).columns == ["x", "b"]
    assert rename_columns(df, {}).columns == ["a", "b"]


def test_nan_to_null_only_floats(spark):
    df = spark.createDataFrame([(float("nan"), float("nan"), 1, "NaN"), (1.5, None, 2, "x")],
                               "d double, f float, i int, s string")
    out = nan_to_null(df).collect()
    assert out[0]["d"] is None and out[0]["f"] is None and out[0]["s"] == "NaN"
    assert out[1]["d"] == 1.5 and out[1]["f"] is None
    assert nan_to_null(df).schema == df.schema


def test_force_string_keeps_null(spark):
    df = spark.createDataFrame([(1, None), (None, 2.5)], "a int, b double")
    assert rows(force_string(df, ["a", "b"])) == [("1", None), (None, "2.5")]
    with pytest.raises(KeyError):
        force_string(df, ["zz"])


TARGET = T.StructType([
    T.StructField("ti", T.ByteType()), T.StructField("si", T.ShortType()), T.StructField("i", T.IntegerType()),
    T.StructField("bi", T.LongType()), T.StructField("f", T.FloatType()), T.StructField("d", T.DoubleType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("dt", T.DateType()),
    T.StructField("b", T.BooleanType()), T.StructField("s", T.StringType()),
    T.StructField("dec", T.DecimalType(12, 2))])


def _src(spark, **over):
    base = {"ti": "1", "si": "2", "i": 3.0, "bi": "4", "f": "1.5", "d": 2, "ts": "2024-01-01 10:00:00",
            "dt": "2024-01-02", "b": True, "s": 7, "dec": "12.345", "extra": "kept"}
    base.update(over)
    schema = ("ti string, si string, i double, bi string, f string, d int, ts string, dt string, b boolean, "
              "s int, dec string, extra string")
    return spark.createDataFrame([tuple(base.values())], schema)


def test_conform_casts_every_target_type(spark):
    out = conform_schema(_src(spark), TARGET)
    assert [f.dataType for f in out.schema.fields][:11] == [f.dataType for f in TARGET.fields]
    r = out.first()
    assert (r["ti"], r["i"], r["s"], r["dec"], r["extra"]) == (1, 3, "7", decimal.Decimal("12.35"), "kept")
    assert conform_schema(out, TARGET).schema == out.schema  # idempotent


@pytest.mark.parametrize("over", [{"ti": "300"}, {"i": 1.5}, {"bi": "abc"}, {"i": float("nan")}, {"dt": "x"}])
def test_conform_strict_raises(spark, over):
    with pytest.raises(Exception, match="cannot conform"):
        conform_schema(_src(spark, **over), TARGET).collect()


def test_conform_lenient_gives_null(spark):
    r = conform_schema(_src(spark, ti="300", bi="abc"), TARGET, strict=False).first()
    assert r["ti"] is None and r["bi"] is None


def test_conform_null_stays_null(spark):
    r = conform_schema(_src(spark, bi=None, s=None), TARGET).first()
    assert r["bi"] is None and r["s"] is None


def test_conform_missing_target_column(spark):
    with pytest.raises(KeyError):
        conform_schema(_src(spark).drop("dec"), TARGET)


def test_conform_drop_extra(spark):
    assert "extra" not in conform_schema(_src(spark), TARGET, keep_extra=False).columns


def test_parse_and_drop(spark):
    df = spark.createDataFrame([(1, "a"), (2, "error"), (3, None)], "id int, t string")
    out = parse_and_drop(df, lambda d: F.when(F.col("t") != "error", F.struct("id", F.upper("t").alias("u"))))
    assert rows(out) == [(1, "A")]


def test_delete_predicate_null_keeps_row(spark):
    df = spark.createDataFrame([("2024-01-01", 1), (None, 2), ("2024-01-02", 3)], "run_date string, id int")
    assert rows(keep_where_not(df, "run_date = '2024-01-01'"), "id") == [(2,), (3,)]
