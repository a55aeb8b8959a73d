"""Rules on a file stream of the events table."""

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF01
from rowsieve import validate
from rowsieve.catalog.queries import EVENT_RULES, table
from rowsieve.streaming import flag_stream, route_stream


def events_stream(spark, folder):
    # the events table split into several files so the stream sees batches
    table(spark, SF01, "events").repartition(4, "event_id").write.parquet(folder)
    schema = table(spark, SF01, "events").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_flag_stream_row_local(spark):
    base = tempfile.mkdtemp(prefix="rowsieve-stream-", dir="/tmp")
    stream = events_stream(spark, os.path.join(base, "in"))
    flagged = flag_stream(stream, EVENT_RULES).select("event_id", F.array_join("failed_rules", ",").alias("f"))
    q = (
        flagged.writeStream.format("parquet")
        .option("path", os.path.join(base, "out"))
        .option("checkpointLocation", os.path.join(base, "ckpt"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(base, "out"))
    batch = validate(table(spark, SF01, "events"), EVENT_RULES).flagged.select(
        "event_id", F.array_join("failed_rules", ",").alias("f")
    )
    assert got.count() == batch.count()
    assert got.exceptAll(batch).count() == 0


def test_route_stream_per_batch(spark):
    base = tempfile.mkdtemp(prefix="rowsieve-route-", dir="/tmp")
    stream = events_stream(spark, os.path.join(base, "in"))
    rules = EVENT_RULES + [{"name": "user_unique_in_batch", "type": "unique_check", "column": "user_id", "priority": 3}]
    q = route_stream(
        stream,
        rules,
        path=os.path.join(base, "out"),
        checkpoint_location=os.path.join(base, "ckpt"),
    )
    q.awaitTermination(180)
    out = spark.read.parquet(os.path.join(base, "out"))
    good, bad = out.where("dq_status = 'passed'"), out.where("dq_status = 'rejected'")
    assert good.select("batch_id").union(bad.select("batch_id")).distinct().count() == 4
    assert good.count() + bad.count() == table(spark, SF01, "events").count()
    # row-local verdicts agree with the batch run
    row_local = validate(table(spark, SF01, "events"), EVENT_RULES).bad.select("event_id")
    flagged_ids = bad.where(F.exists("failed_rules", lambda x: x != "user_unique_in_batch")).select("event_id")
    assert flagged_ids.exceptAll(row_local).count() == 0 and row_local.exceptAll(flagged_ids).count() == 0


def test_dataset_rules_refused_on_stream(spark):
    import pytest

    from rowsieve import RuleError

    base = tempfile.mkdtemp(prefix="rowsieve-refuse-", dir="/tmp")
    stream = events_stream(spark, os.path.join(base, "in"))
    with pytest.raises(RuleError, match="route_stream"):
        validate(stream, [{"name": "u", "type": "unique_check", "column": "user_id", "priority": 1}])
