"""The minimum slice end to end: dated extract -> NaN to NULL -> conform ->
upsert (update listed columns), then a count check on the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.operators.conform import conform_schema, nan_to_null
from dockhand.operators.merge import upsert_update
from dockhand.plans.catalog import table, view
from dockhand.sources.tables import dated_extract

TARGET = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DecimalType(12, 2)),
    T.StructField("o_orderdate", T.DateType())])


def flagship(spark: SparkSession, sf: str, run_date: str = "2000-01-01") -> DataFrame:
    v = view(spark, sf, "orders")
    cols = ", ".join(f.name for f in TARGET.fields)
    target = conform_schema(table(spark, sf, "orders").select(*[f.name for f in TARGET.fields])
                            .where(F.col("o_orderkey") % 10 < 8), TARGET, keep_extra=False)

    def builder(d: str) -> str:
        return (f"SELECT {cols} FROM {v} WHERE o_orderkey % 10 >= 6 "
                f"AND o_orderdate < CAST(:run_date AS DATE)")
    fresh = nan_to_null(dated_extract(spark, builder, run_date, args={"run_date": run_date}))
    fresh = conform_schema(fresh.withColumn("o_orderstatus", F.lit("U")), TARGET, keep_extra=False)
    return upsert_update(target, fresh, ["o_orderkey"], ["o_orderstatus", "o_totalprice"])
