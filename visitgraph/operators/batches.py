"""Queue fingerprints and the cutting of scans into jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Pages of a job, by type.
PAGES = {"PM": 6, "CM": 2}


def queue_item() -> Column:
    """Hash of one queue item: its label, id and time."""
    return F.sha2(F.concat_ws(":", "event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp"))), 256)


def set_fingerprint(h: Column) -> Column:
    """One hash of a set of SHA-256 hashes, whatever their order: their number and the exclusive or of four 60-bit parts.

    An aggregate with partial sums: nothing is gathered or sorted. The set must hold each hash once.
    """
    parts = [F.bit_xor(F.conv(F.substr(h, F.lit(1 + 15 * i), F.lit(15)), 16, 10).cast("long")) for i in range(4)]
    return F.sha2(F.concat_ws(":", F.count("*"), *parts), 256)


def segment_jobs(pages: DataFrame) -> DataFrame:
    """(source, starts, ends, kind): jobs cut from the pages (source, page, kind) of each scan, ends exclusive.

    A job starts at a page with a kind. It has its nominal length if the scan ends or a job starts there; else a PM job
    may be two or four pages shorter (longer first); else an even rest up to the scan's end. If any step finds no end,
    the whole scan is one row ``needs_review``. Where a page would end is a matter of pages up to six ahead; only these
    (end, kind) numbers of one scan are then walked in order. A scan's pages are few: they come from one file.
    """
    w = Window.partitionBy("source").orderBy("page")
    d = pages.withColumns({"at": F.row_number().over(w) - 1, **{f"k{n}": F.lead("kind", n).over(w) for n in (2, 4, 6)}, "left": F.count("*").over(Window.partitionBy("source"))})
    d = d.withColumn("left", F.col("left") - F.col("at"))
    starts = lambda n: F.coalesce(F.col(f"k{n}") != "", F.lit(False))
    size = F.when(F.col("kind") == "CM", F.when((F.col("left") == 2) | starts(2), 2)).when(
        F.col("kind") == "PM", F.when((F.col("left") == 6) | starts(6), 6).when(starts(4), 4).when(starts(2), 2).when((F.col("left") < 6) & (F.col("left") % 2 == 0), F.col("left").cast("int")))
    steps = d.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce(size, F.lit(-1)).alias("size"), "kind"))).alias("l"))
    jobs = "array<struct<starts:int,ends:int,kind:string>>"
    begin = F.struct(F.lit(0).alias("next"), F.lit(True).alias("ok"), F.expr(f"cast(array() as {jobs})").alias("jobs"))

    def step(acc: Column, x: Column) -> Column:
        stop = x["at"] + x["size"]
        job = F.struct(x["at"].alias("starts"), stop.alias("ends"), x["kind"].alias("kind"))
        moved = F.struct(stop.alias("next"), (x["size"] > 0).alias("ok"), F.concat(acc["jobs"], F.array(job)).alias("jobs"))
        return F.when(acc["ok"] & (acc["next"] == x["at"]), moved).otherwise(acc)

    walked = steps.select("source", F.aggregate("l", begin, step).alias("w"))
    review = F.expr(f"cast(array(named_struct('starts', null, 'ends', null, 'kind', 'needs_review')) as {jobs})")
    return walked.select("source", F.explode(F.when(F.col("w.ok"), F.col("w.jobs")).otherwise(review)).alias("j")).select("source", "j.*")
