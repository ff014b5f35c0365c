import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from dockhand.operators.merge import upsert_update
from dockhand.sinks.partitions import read_partitioned
from dockhand.streaming.batches import load_each_batch


def test_stream_batches_merge_into_partitions(spark, tmp_dir):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    stream = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
              .option("maxFilesPerTrigger", 1).parquet(SF_SMALL)
              .select("event_id", "value", F.date_format("ts", "yyyy-MM-dd").alias("d")))
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("value", T.DoubleType()),
                           T.StructField("d", T.StringType())])
    path = os.path.join(tmp_dir, "t")
    q = load_each_batch(stream, path, schema, ["d"], os.path.join(tmp_dir, "ckpt"),
                        merge=lambda t, s: upsert_update(t, s, ["event_id"], ["value"]))
    q.awaitTermination(120)
    out = read_partitioned(spark, path, schema)
    assert out.count() == events.count()
    assert out.select("event_id").distinct().count() == events.count()
