"""Mixing sources to target weights by the cube method of balanced sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.llm.common import WORD, durable, private

EPS = 1e-9


def targets(sizes: Sequence[tuple[object, int]], weights: Sequence[float], share: float, most: float) -> list[float]:
    """Each source's target: ``share`` of all sizes dealt by weight, never above ``most`` times a source's own size.

    What a stopped source leaves over is dealt again by weight among the others until none is above.
    """
    total, out, open_ = share * sum(n for _, n in sizes), [0.0] * len(sizes), set(range(len(sizes)))
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    while open_:
        left = total - sum(out[i] for i in range(len(sizes)) if i not in open_)
        unit = left / sum(w[i] for i in open_)
        full = [i for i in open_ if unit * w[i] >= most * sizes[i][1]]
        if not full:
            for i in open_:
                out[i] = unit * w[i]
            break
        for i in full:
            out[i] = most * sizes[i][1]
            open_.discard(i)
    return out


def flight(p: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Flight phase: moves inclusion probabilities ``p`` along the null space of the balancing rows until few are fractional.

    ``x`` (units by constraints) holds what is balanced, each unit's share of the totals. A window of one unit more than
    there are constraints moves at a time, by a null vector of theirs, until one of them is 0 or 1 and the next unit
    takes its place; both directions are weighed so that every probability keeps its mean. At most as many units as
    constraints stay fractional. Draws come from a fixed sequence, so reruns agree.
    """
    p, q = p.copy(), x.shape[1]
    live = [int(i) for i in np.flatnonzero((p > EPS) & (p < 1 - EPS))]
    draws = np.random.default_rng(len(p)).random(len(live) + 1)
    at, window = 0, []
    for k in range(len(live) + 1):
        while len(window) < q + 1 and at < len(live):
            window.append(live[at])
            at += 1
        if len(window) <= q:
            return p
        a = x[window]
        if q == 2:  # the null vector of a 2 x 3 matrix is a cross product
            u = np.array([a[1, 0] * a[2, 1] - a[2, 0] * a[1, 1], a[2, 0] * a[0, 1] - a[0, 0] * a[2, 1], a[0, 0] * a[1, 1] - a[1, 0] * a[0, 1]])
            if abs(u).max() < 1e-12 * max(abs(a).max() ** 2, 1e-300):
                u = np.array([a[1, 0], -a[0, 0], 0.0]) if abs(a[:2, 0]).max() > 0 else np.array([1.0, -1.0, 0.0])
        else:
            u = np.linalg.svd(a.T)[2][-1]
        u = u / abs(u).max()
        v = p[window]
        up = min(((1 - v[i]) / u[i] if u[i] > 0 else -v[i] / u[i]) for i in range(len(u)) if abs(u[i]) > 1e-12)
        down = min((v[i] / u[i] if u[i] > 0 else (v[i] - 1) / u[i]) for i in range(len(u)) if abs(u[i]) > 1e-12)
        step = up if draws[k] * (up + down) < down else -down
        p[window] = np.clip(v + step * u, 0, 1)
        window = [i for i in window if EPS < p[i] < 1 - EPS]
    return p


def landing(p: np.ndarray, wished: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Settles the few units of ``p`` still fractional, largest first, each to the side that keeps nearest to the words wished.

    What this leaves over or short is then worked off by exchanging settled units, from large to small, wherever that
    brings the sum of words nearer to the wished one. Only units with a fractional wish change.
    """
    out, goal = p.copy(), float((wished * size).sum())
    for i in sorted(np.flatnonzero((p > EPS) & (p < 1 - EPS)), key=lambda i: (-size[i], i)):
        out[i] = float(p[i] >= 0.5)
    out = np.round(out)
    over = float((out * size).sum()) - goal
    for i in sorted(np.flatnonzero((wished > EPS) & (wished < 1 - EPS) & (size > 0)), key=lambda i: (-size[i], i)):
        change = size[i] if out[i] == 0 else -size[i]
        if abs(over + change) < abs(over):
            out[i], over = 1 - out[i], over + change
    return out


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", group: int = 4096, key: Column | None = None, max_sources: int = 100_000) -> DataFrame:
    """(id, key, source, size, source_size, target, copies, taken): how often each document is taken.

    A document's size is its number of words. Sources by code point, null last, have ``weights`` in turn; their targets
    come from ``targets``. All documents of a source are wished equally often, r = target / size of the source (at most
    ``most``): floor(r) whole copies each, and one more with probability r - floor(r), settled by the cube method, which
    balances the number of documents and of words at once. Units move in order of falling size, so each balances against
    its like and what is left at the end is small.

    Flight runs in groups of about ``group`` documents of one source, dealt by a hash of the row, so a source with a third
    of all rows is many tasks; what each leaves fractional (two units) meets by source in the next round, ``group`` to one
    again, until one group is left, which lands. Only (id, key, source, size) is shuffled, where ``key`` is a number that the caller may name (0 otherwise). The source table (at most
    ``max_sources`` rows, checked) is all that the driver sees.

    Null texts and texts without words have size 0 and are taken as 0 words (floor(r) copies). Rows with equal ids are
    separate units with equal draws' order; null ids are units too. An empty table gives an empty table.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    units = durable(docs.select(F.col(id_col).cast("string").alias("id"), F.col(source_col).alias("source"), size.alias("size"), (F.lit(0) if key is None else key).cast("long").alias("key")))
    table = units.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("docs")).orderBy(F.col("source").asc_nulls_last()).limit(max_sources + 1).collect()
    if len(table) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    goal = targets([(r["source"], r["words"]) for r in table], weights, share, most)
    spark = docs.sparkSession
    plan = spark.createDataFrame([(r["source"], r["words"], float(t), float(t / r["words"]) if r["words"] else 0.0, max(1, math.ceil(r["docs"] / group))) for r, t in zip(table, goal, strict=True)], "source string, source_size long, target double, r double, parts int")
    d = units.join(F.broadcast(plan), units["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    # r reaches `most` exactly where a source is stopped; rounding must not turn that into a fraction
    whole = F.floor(F.col("r") + EPS)
    d = d.withColumn("base", whole.cast("int")).withColumn("p", F.greatest(F.col("r") - whole, F.lit(0.0))).withColumn("p", F.when((F.col("p") < EPS) | (F.col("size") == 0), 0.0).otherwise(F.col("p")))
    d = d.withColumn("draw", F.xxhash64("id", "key", "size")).withColumn("part", F.pmod("draw", F.col("parts")).cast("int"))
    parts = max([p["parts"] for p in plan.select("parts").collect()] or [1])
    schema = d.schema

    def settle(last: bool):
        def run(g: pd.DataFrame) -> pd.DataFrame:
            g = g.sort_values(["size", "draw", "key"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
            s, p = g["size"].to_numpy(np.float64), g["p"].to_numpy(np.float64)
            out = flight(p, np.column_stack((np.ones(len(p)), s / max(s.mean(), 1.0))))
            g["p"] = landing(out, p, s) if last else np.where(out < EPS, 0.0, np.where(out > 1 - EPS, 1.0, out))
            return g

        return run

    done = None
    while True:
        last = parts == 1
        d = durable(d.groupBy("source", "part").applyInPandas(settle(last), schema))
        if last:
            break
        fractional = F.col("p").between(EPS, 1 - EPS)
        settled = d.where(~fractional)
        done = settled if done is None else done.union(settled)
        parts = max(1, math.ceil(parts * 2 / group))
        d = d.where(fractional).withColumn("part", F.pmod(F.col("part"), F.lit(parts)))
    d = d if done is None else done.union(d)
    copies = F.col("base") + F.round("p").cast("int")
    return d.select("id", "key", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with each row as often as the mix takes it (none, once or more); columns unchanged.

    Rows meet their copies by a hash of id, text and source; the copies of equal rows are shared out among them.
    Columns of ``docs`` keep names and values, whatever their names.
    """
    key, every, rows, n, copy = private(docs, "key", "every", "rows", "n", "copy")
    name = F.xxhash64("doc_id", "source", F.sha2("text", 256))
    taken = mix(docs, key=name, **options).groupBy(F.col("key").alias(key)).agg(F.sum("copies").alias(every), F.count("*").alias(rows)).where(F.col(every) > 0)
    d = docs.withColumn(key, name).join(taken, key)
    nth = F.when(F.col(rows) == 1, 1).otherwise(F.row_number().over(Window.partitionBy(key).orderBy("doc_id")))
    d = d.withColumn(n, F.floor(F.col(every) / F.col(rows)) + (nth <= F.col(every) % F.col(rows)).cast("int"))
    return d.where(F.col(n) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)


def op6_mixing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(F.col("id").cast("long").alias("doc_id"), "size", "source_size", "target", "taken", "copies")
