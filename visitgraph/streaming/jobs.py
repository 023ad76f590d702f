"""Structured Streaming twins of the queue and index operators."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitgraph.operators.batches import queue_item, set_fingerprint
from visitgraph.operators.index import device_records
from visitgraph.operators.tables import settled, spent

RECORD = "gid string, device_key string, modified_at string, due string"


def queue_fingerprints(events: DataFrame, every: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """(starts, fingerprint): one hash of each window's set of queue items; events up to ``late`` late still count."""
    items = events.withWatermark("ts", late).select("ts", queue_item().alias("h")).dropDuplicates(["ts", "h"])
    return items.groupBy(F.window("ts", every)).agg(set_fingerprint(F.col("h")).alias("fingerprint")).select(F.col("window.start").alias("starts"), "fingerprint")


def one_time_notices(reports: DataFrame, within: str = "1 day") -> DataFrame:
    """Reports that need attention, each once within the watermark."""
    return reports.withWatermark("ts", within).where("attention").dropDuplicatesWithinWatermark(["report_id"])


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def manifest(spark: SparkSession, path: str) -> dict:
    """The newest committed version of a record table: its number, each bucket's folder, the last batch of each run."""
    system, at = _files(spark, f"{path}/manifest")
    names = [x.getPath().getName() for x in system.listStatus(at)] if system.exists(at) else []
    versions = [int(n) for n in names if n.isdigit()]
    if not versions:
        return {"version": -1, "buckets": {}, "runs": {}}
    return json.loads(spark.read.text(f"{path}/manifest/{max(versions)}", wholetext=True).first()[0])


def commit(spark: SparkSession, path: str, new: dict) -> None:
    """Writes a manifest beside its place, then renames it: a version is there whole or not at all."""
    system, at = _files(spark, f"{path}/manifest/{new['version']}")
    _, beside = _files(spark, f"{path}/manifest/.{uuid.uuid4().hex}")
    out = system.create(beside)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    if not system.rename(beside, at):
        raise RuntimeError(f"version {new['version']} of {path} was committed by another run")


def read_records(spark: SparkSession, path: str, buckets: set[int] | None = None) -> DataFrame:
    """The stored records (all, or those of some hash buckets) of the newest version."""
    folders = [f for b, f in manifest(spark, path)["buckets"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(RECORD).parquet(*[f"{path}/{f}" for f in folders]) if folders else spark.createDataFrame([], RECORD)


def upsert_batch(batch: DataFrame, path: str, run: str, number: int, buckets: int = 64) -> None:
    """Merges one batch of changed work records into the table at ``path``.

    Records lie in hash buckets of their gid. Only buckets that the batch touches are read, merged and written, into new
    folders; the others keep their files. A change counts only if it was modified later than the stored record (an equal
    time keeps the stored one), so late data can't undo newer data. A new manifest, which points to each bucket's folder,
    makes all of it visible at once. A batch that this run has committed already is skipped; another run goes on from the
    table as it stands.
    """
    spark = batch.sparkSession
    now = manifest(spark, path)
    if now["runs"].get(run, -1) >= number:
        return
    new = device_records(batch).select("gid", "device_key", F.col("modified_at").cast("string").alias("modified_at"), "due", F.lit(0).alias("stored"))
    new = settled(new.withColumn("bucket", F.pmod(F.xxhash64("gid"), F.lit(buckets)).cast("int")))
    touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
    old = read_records(spark, path, touched).select("gid", "device_key", "modified_at", "due", F.lit(1).alias("stored"), F.pmod(F.xxhash64("gid"), F.lit(buckets)).cast("int").alias("bucket"))
    latest = new.unionByName(old).groupBy("bucket", "gid").agg(F.max(F.struct("modified_at", "stored", "device_key", "due")).alias("r"))
    folder = f"data/{uuid.uuid4().hex}"
    latest.select("bucket", "gid", "r.device_key", "r.modified_at", "r.due").repartition("bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}")
    spent(new)
    commit(spark, path, {"version": now["version"] + 1, "buckets": now["buckets"] | {str(b): f"{folder}/bucket={b}" for b in touched}, "runs": now["runs"] | {run: number}})


def upsert_records(changes: DataFrame, path: str, checkpoint: str, buckets: int = 64):
    """Keeps the newest device record of every gid at ``path``: a query that merges each micro-batch, see ``upsert_batch``."""
    return changes.writeStream.foreachBatch(lambda batch, number: upsert_batch(batch, path, checkpoint, number, buckets)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
