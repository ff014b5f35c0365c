"""Mixing sources to target weights by Poisson replication.

Every source s has a target share w_s of the output, measured in bytes of
text (plus one a row).  Its mean repetition rate is w_s * epochs * total bytes
/ bytes of s.  A document appears N times, N drawn from a Poisson
distribution of that mean by inversion: a uniform number comes from a hash of
the seed and the row's name, and N is how many values of the cumulative distribution
lie below it.  Decisions depend on the seed, the rows and the source's totals
only, never on partitioning or retries.  The copies are dealt to partitions by
a hash of (seed, name, copy) and sorted by another one inside: a global
shuffle in one exchange.

A row's name is its doc_id.  Rows without one, and rows that share one, are named by
a digest of all their columns and, where rows are equal throughout, a number from 0: each
is drawn by itself, so a source keeps its target weight, and no name is held by many rows.
Equal rows are counted before they are shuffled, never gathered.

Without explicit weights the shares follow ``n_s ** TEMPERATURE`` over the
sources' bytes n_s, which lifts small sources.  Given weights are scaled to sum to
one; a source without a weight (or of weight 0) is left out, a weight for a
source that has no rows gives nothing.

A null source is a source of its own.  Null and empty texts count one byte
and are copied like others.  The columns of the input and one more
(``replica``, or the name given) are returned; an input column of that name is replaced.
An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructField, StructType

from dockhand.llm.common import drop_rows, settle, take_rows

SEED = "mix-1"
TEMPERATURE = 0.5
EPOCHS = 1.0
_BITS = 52


def uniform(seed: str, name: str) -> Column:
    """A number in [0, 1) from the MD5 of the seed and a name."""
    text = F.concat_ws(":", F.lit(seed), F.col(name))
    head = F.conv(F.substring(F.md5(text.cast("binary")), 1, _BITS // 4), 16, 10).cast("long")
    return head / F.lit(float(1 << _BITS))


def _as_text(field: StructField) -> Column:
    """A column's value as text; null as empty."""
    nested = isinstance(field.dataType, (ArrayType, MapType, StructType))
    value = F.to_json(F.struct(field.name)) if nested else F.col(field.name).cast("string")
    return F.coalesce(value, F.lit(""))


def named_rows(docs: DataFrame) -> DataFrame:
    """``docs`` with ``__name``, a text that no two rows share."""
    named = docs.withColumn("__name", F.col("doc_id").cast("string"))
    shared = settle(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    odd = docs.where("doc_id is null")
    if not shared.isEmpty():
        odd = odd.unionByName(take_rows(docs, shared, "doc_id"))
        named = drop_rows(named, shared, "doc_id")
    elif odd.isEmpty():
        return named
    digest = F.md5(F.concat_ws("\x1f", *[_as_text(f) for f in docs.schema.fields]).cast("binary"))
    counted = odd.groupBy(*docs.columns).agg(F.count(F.lit(1)).alias("__rows"))
    each = counted.withColumn("__nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__rows") - 1)))
    return (named.where("doc_id is not null")
            .unionByName(each.withColumn("__name", F.concat_ws(":", digest, F.col("__nth").cast("string"))).drop("__rows", "__nth")))


def _cumulative(rate: str) -> Column:
    """Poisson cumulative probabilities of 0, 1, 2, ... far into the tail, with
    the terms kept as logarithms so that large rates do not underflow."""
    last = (F.col(rate) + 12 * F.sqrt(rate) + 20).cast("int")
    start = F.struct(F.array().cast("array<double>").alias("cdf"), (-F.col(rate)).alias("log_p"), F.lit(0.0).alias("sum"))

    def step(acc, k):
        total = acc["sum"] + F.exp(acc["log_p"])
        return F.struct(F.concat(acc["cdf"], F.array(total)).alias("cdf"),
                        (acc["log_p"] + F.log(F.col(rate) / k)).alias("log_p"), total.alias("sum"))

    return F.aggregate(F.transform(F.sequence(F.lit(1), last), lambda k: k.cast("double")), start, step, lambda acc: acc["cdf"])


def source_rates(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE,
                 epochs: float = EPOCHS) -> DataFrame:
    """(source, bytes, rate, cdf): one row per source."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    per = settle(docs.select("source", size.alias("b")).groupBy("source").agg(F.sum("b").alias("bytes")))
    if weights is None:
        share = F.pow(F.col("bytes").cast("double"), F.lit(temperature))
    else:
        share = F.lit(0.0)
        for source, weight in weights.items():
            share = F.when(F.col("source") == source, F.lit(float(weight))).otherwise(share)
    per = per.withColumn("share", share)
    all_shares, all_bytes = per.agg(F.sum("share"), F.sum("bytes")).first()
    per = per.where("share > 0")
    rate = F.col("share") / F.lit(all_shares) * epochs * F.lit(all_bytes) / F.col("bytes")
    return settle(per.select("source", "bytes", rate.alias("rate")).withColumn("cdf", _cumulative("rate")))


def poisson_mix(docs: DataFrame, weights: dict[str, float] | None = None, temperature: float = TEMPERATURE,
                epochs: float = EPOCHS, seed: str = SEED, replica: str = "replica") -> DataFrame:
    """The mixed corpus: the columns of ``docs`` and ``replica`` (from 0), globally shuffled."""
    rates = source_rates(docs, weights, temperature, epochs)
    plain = docs.drop(replica)
    keyed = named_rows(plain).withColumn("__u", uniform(seed, "__name"))
    matched = keyed.join(rates.select(F.col("source").alias("__source"), F.col("cdf").alias("__cdf")),
                         F.col("source").eqNullSafe(F.col("__source")))
    copies = F.size(F.filter("__cdf", lambda c: c <= F.col("__u")))
    counted = matched.withColumn("__n", copies).where("__n > 0").drop("__u", "__cdf", "__source")
    out = counted.withColumn(replica, F.explode(F.sequence(F.lit(0), F.col("__n") - 1))).drop("__n")
    key = [F.lit(seed), F.col("__name"), F.col(replica)]
    return out.repartition(F.xxhash64(*key)).sortWithinPartitions(F.xxhash64(*key, F.lit("order"))).drop("__name")
