"""The streaming canonicaliser equals the batch one on the same input and
drops duplicate deliveries."""
import os

import pandas as pd

from lotwise.sources.ga4 import canonicalise
from lotwise.streaming.ga4_stream import GA4_STREAM_SCHEMA, start_ga4_stream


def test_stream_matches_batch_and_dedups(spark, tmp_path):
    base = str(tmp_path)
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    pdf = pd.DataFrame({
        "event_timestamp": ["2025-01-01T10:00:00Z", "2025-01-01T10:01:00Z", "2025-01-01T10:02:00Z"],
        "event_name": ["page_view", "view_item", "unknown_thing"], "user_pseudo_id": ["u1"] * 3,
        "ga_session_id": [7, 7, 7], "event_id": ["e1", "e2", "e3"], "item_id": [None, "C1", None],
        "engagement_time_msec": [0.0, 1500.0, 5.0]})
    df = spark.createDataFrame(pdf)
    for c in GA4_STREAM_SCHEMA.fieldNames():
        if c not in df.columns:
            df = df.withColumn(c, __import__("pyspark.sql.functions", fromlist=["lit"]).lit(None).cast(
                GA4_STREAM_SCHEMA[c].dataType))
    df = df.select(*GA4_STREAM_SCHEMA.fieldNames())
    df.write.parquet(os.path.join(src, "part1"))
    df.limit(2).write.parquet(os.path.join(src, "part2"))     # a duplicate delivery
    q = start_ga4_stream(spark, os.path.join(src, "*"), out, ckpt)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = canonicalise(df)
    assert got.count() == 2
    cols = ["event_id", "event_name", "user_id", "session_id", "engagement_time_seconds"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, batch.select(*cols).collect()))
