import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA
from visitgraph.operators.dispatch import backoff
from visitgraph.plans import batches
from visitgraph.sources.fixtures import work_records
from visitgraph.streaming.jobs import manifest, one_time_notices, queue_fingerprints, read_records, upsert_batch, upsert_records
from visitgraph.streaming.state import ROCKS, backoff_stream, streak_alerts


def test_stream_fingerprints_equal_the_batch(spark, tmp_path):
    schema = spark.read.parquet(f"{DATA}/events.parquet").selectExpr("event_type", "event_id", "cast(ts as timestamp) ts")
    schema.orderBy("ts").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = queue_fingerprints(spark.readStream.schema(schema.schema).parquet(f"{tmp_path}/in"))
    name = "f" + uuid.uuid4().hex
    stream.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination(120)
    got = {(r["starts"], r["fingerprint"]) for r in spark.table(name).collect()}
    want = {(r["starts"], r["fingerprint"]) for r in batches.QUERIES["queue_fingerprint"](spark, DATA).collect()}
    assert got and got <= want and len(got) >= len(want) - 4


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def streamed(spark, table, tmp_path, job, pieces=3):
    """The rows that ``job`` makes of ``table``, read as ``pieces`` files of rising time, one a micro-batch."""
    rows = table.orderBy("ts", "event_id").collect()
    step = -(-len(rows) // pieces)
    for i in range(pieces):
        spark.createDataFrame(rows[i * step : (i + 1) * step], table.schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    name = "s" + uuid.uuid4().hex
    job(source).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start().awaitTermination(300)
    return sorted(map(tuple, spark.table(name).collect()))


def test_stream_backoff_equals_the_batch(spark, tmp_path, rocks):
    e = spark.read.parquet(f"{DATA}/events.parquet").where("user_id < 40")
    shots = e.select(F.col("user_id").alias("queue"), "event_id", F.col("ts").cast("timestamp").alias("ts"), F.when(F.col("event_type") != "signup", F.floor(F.col("value") / 40).cast("string")).alias("fingerprint"), (F.col("event_type") == "click").alias("has_input"), (F.col("event_type") == "error").alias("changed_later"))
    got = streamed(spark, shots, tmp_path, backoff_stream)
    assert got and got == sorted(map(tuple, backoff(shots).collect()))


def test_stream_streaks_equal_the_batch(spark, tmp_path, rocks):
    e = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    failed = e.select(F.col("user_id").cast("long").alias("user_id"), F.col("event_id").cast("long").alias("event_id"), "ts", F.when(F.col("event_type") == "error", True).when(F.col("event_type") == "purchase", False).alias("failed"))
    got = streamed(spark, failed, tmp_path, streak_alerts)
    want = batches.QUERIES["failure_streak_alert"](spark, DATA).withColumn("ts", F.col("ts").cast("timestamp"))
    assert got and got == sorted(map(tuple, want.select("user_id", "event_id", "ts").collect()))


def test_notices_once(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:00:0{i}", r, a) for i, (r, a) in enumerate([("a", True), ("a", True), ("b", False), ("c", True), ("a", True)])]
    t = spark.createDataFrame(rows, "event_id long, ts string, report_id string, attention boolean").withColumn("ts", F.col("ts").cast("timestamp"))
    got = streamed(spark, t, tmp_path, lambda s: one_time_notices(s).select("report_id"), pieces=2)
    assert got == [("a",), ("c",)]


def test_merges_rewrite_touched_buckets_only(spark, tmp_path):
    """Late data, a batch run again, a second run with a new checkpoint; untouched buckets keep their files."""
    path = f"{tmp_path}/table"
    records = work_records(spark, DATA).where("ord1 % 5 = 0").dropDuplicates(["gid"])
    first = records.withColumn("modified_at", F.lit("2024-02-01"))
    upsert_batch(first, path, "run", 0)
    before = manifest(spark, path)
    want = {r["gid"] for r in records.select("gid").collect()}
    assert {r["gid"] for r in read_records(spark, path).collect()} == want
    gid = min(want)
    one = records.where(F.col("gid") == gid)
    upsert_batch(one.withColumn("modified_at", F.lit("2024-01-01")), path, "run", 1)  # late
    upsert_batch(one.withColumn("modified_at", F.lit("2024-03-01")).withColumn("name", F.lit("QMH / CX50 / USN1234567")), path, "run", 2)
    upsert_batch(one.withColumn("modified_at", F.lit("2024-04-01")), path, "run", 2)  # the same batch again: skipped
    after = manifest(spark, path)
    changed = {b for b in after["buckets"] if after["buckets"][b] != before["buckets"].get(b)}
    assert len(changed) == 1 and after["version"] == 2 and len(before["buckets"]) > 10
    stored = {r["gid"]: r for r in read_records(spark, path).collect()}
    assert set(stored) == want and stored[gid]["modified_at"] == "2024-03-01" and stored[gid]["device_key"] == "USN1234567"
    source = one.withColumn("modified_at", F.lit("2024-05-01")).select("gid", "ord1", "ord2", "k", "dev", "project_name", "due_on", "name", "notes", "modified_at")
    source.write.parquet(f"{tmp_path}/in")
    upsert_records(spark.readStream.schema(source.schema).parquet(f"{tmp_path}/in"), path, f"{tmp_path}/check").awaitTermination(120)
    again = {r["gid"]: r["modified_at"] for r in read_records(spark, path).collect()}
    assert set(again) == want and again[gid] == "2024-05-01" and manifest(spark, path)["version"] == 3
