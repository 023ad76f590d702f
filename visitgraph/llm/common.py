"""Helpers shared by the corpus operators: durable tables, span arrays, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SPAN = "struct<s:int,e:int,kind:string,m:string>"
#: Elements that ``scan`` folds at a time.
CHUNK = 128


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; an error where it is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return path.rstrip("/")


def durable(df: DataFrame) -> DataFrame:
    """Cuts lineage: writes ``df`` as Parquet into the shared folder and reads it back.

    The files outlive any executor, so a lost one costs only its running tasks. ``spent`` deletes them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def spent(*tables: DataFrame) -> None:
    """Deletes the files of ``durable`` tables that nothing reads any more."""
    for t in tables:
        jvm = t.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def private(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` has not, whatever the caller called its own."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def runs(parts: Iterator[pd.DataFrame], keys: list[str], most: int | None = None) -> Iterator[pd.DataFrame]:
    """Regroups batches that are sorted by ``keys`` so that no run of equal keys is cut: each frame holds whole runs.

    With ``most``, a run of more rows than that is handed on in parts.
    """
    rest = None
    for part in parts:
        if not len(part):
            continue
        part = part if rest is None else pd.concat([rest, part], ignore_index=True)
        last = (part[keys] == part[keys].iloc[-1]).all(axis=1)
        rest = part[last]
        if not last.all():
            yield part[~last].reset_index(drop=True)
        if most and len(rest) >= most:
            yield rest.reset_index(drop=True)
            rest = None
    if rest is not None:
        yield rest.reset_index(drop=True)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scan(xs: Column, zero: int, step: Callable[[Column, Column], Column]) -> Column:
    """Running states (whole numbers) of ``step(state, x)`` over array ``xs``, one after each element.

    Folds chunks of ``CHUNK`` elements and appends whole chunks, as every append copies its array: time grows far less
    than with the square of the length.
    """
    empty = lambda kind: F.expr(f"cast(array() as {kind})")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(xs), F.lit(1)) - 1) / CHUNK).cast("int")), lambda c: F.slice(xs, c * CHUNK + 1, F.lit(CHUNK)))

    def append(acc: Column, x: Column) -> Column:
        return bound(step(acc["at"], x).cast("int"), lambda v: F.struct(v.alias("at"), F.concat(acc["out"], F.array(v)).alias("out")))

    def follow(acc: Column, chunk: Column) -> Column:
        inner = F.aggregate(chunk, F.struct(acc["at"].alias("at"), empty("array<int>").alias("out")), append)
        return bound(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    return F.flatten(F.aggregate(chunks, F.struct(F.lit(zero).cast("int").alias("at"), empty("array<array<int>>").alias("out")), follow, lambda acc: acc["out"]))


def matches(text: Column, pattern: str) -> Column:
    """Array of struct(s, e, m, b, a) with the leftmost non-overlapping matches of ``pattern``.

    ``s`` and ``e`` are code points, ``e`` exclusive; ``b`` and ``a`` are up to 24 code points before and one after.
    ``split`` with limit -1 gives the pieces between the same matches that ``regexp_extract_all`` lists, so running
    lengths give the offsets, and pieces give the context without another search of the text.
    """

    def placed(x: Column) -> Column:
        hits, gaps = x["hits"], x["gaps"]
        before = F.zip_with(F.concat(F.array(F.lit("")), F.slice(hits, F.lit(1), F.size(hits) - 1)), F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.right(F.concat(F.right(h, F.lit(24)), g), F.lit(24)))
        after = F.zip_with(F.slice(gaps, F.lit(2), F.size(hits)), F.concat(F.slice(hits, F.lit(2), F.size(hits)), F.array(F.lit(""))), lambda g, h: F.left(F.concat(g, h), F.lit(1)))
        ends = scan(F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h)), 0, lambda at, n: at + n)
        sides = F.zip_with(before, after, lambda b, a: F.struct(b.alias("b"), a.alias("a")))
        spans = F.zip_with(ends, hits, lambda e, h: F.struct((e - F.length(h)).alias("s"), e.alias("e"), h.alias("m")))
        return F.zip_with(spans, sides, lambda p, q: F.struct(p["s"].alias("s"), p["e"].alias("e"), p["m"].alias("m"), q["b"].alias("b"), q["a"].alias("a")))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.expr("cast(array() as array<struct<s:int,e:int,m:string,b:string,a:string>>)")
    return bound(hits, lambda h: F.when(F.size(h) > 0, bound(F.struct(h.alias("hits"), F.split(text, pattern, -1).alias("gaps")), placed)).otherwise(none))


def spans_of(text: Column, pattern: str, kind: str, keep, gate: Column | None = None) -> Column:
    """Array of struct(s, e, kind, m): the ``matches`` for which ``keep(m)``. ``gate`` skips texts that can't match."""
    kept = F.filter(matches(text, pattern), lambda x: keep(x["m"]))
    found = F.transform(kept, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(kind).alias("kind"), x["m"].alias("m")))
    return F.when(gate, found).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")) if gate is not None else found


def clear_of(spans: Column, base: Column) -> Column:
    """Those of ``spans`` that overlap none of ``base`` (both arrays of structs with s and e), by start.

    One sort and two running bounds: the furthest end of base spans that start no later, the nearest start of later ones.
    """
    far = 2**31 - 1

    def compared(x: Column) -> Column:
        every = F.array_sort(F.concat(F.transform(x["base"], lambda y: F.struct(y["s"].alias("s"), F.lit(0).alias("o"), y["e"].alias("e"), F.lit(0).alias("i"))), F.transform(x["spans"], lambda y, i: F.struct(y["s"].alias("s"), F.lit(1).alias("o"), y["e"].alias("e"), (i + 1).alias("i")))))
        return bound(every, lambda a: kept(a, x["spans"]))

    def kept(every: Column, spans: Column) -> Column:
        ends = scan(every, 0, lambda at, y: F.when(y["o"] == 0, F.greatest(at, y["e"])).otherwise(at))
        starts = F.reverse(scan(F.reverse(every), far, lambda at, y: F.when(y["o"] == 0, F.least(at, y["s"])).otherwise(at)))
        free = F.filter(F.zip_with(every, F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("e"), s.alias("s"))), lambda y, z: F.when((y["o"] == 1) & (z["e"] <= y["s"]) & (z["s"] >= y["e"]), y["i"])), lambda i: i.isNotNull())
        return F.transform(free, lambda i: F.element_at(spans, i))

    return bound(F.struct(spans.alias("spans"), base.alias("base")), lambda x: F.when((F.size(x["base"]) > 0) & (F.size(x["spans"]) > 0), compared(x)).otherwise(x["spans"]))


def apart(spans: Column) -> Column:
    """Of overlapping ``spans`` the one that starts first (then the longest) stays; sorted by start."""

    def taken(x: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), scan(x, 0, lambda at, y: F.when(y["s"] >= at, y["e"]).otherwise(at)))
        return F.transform(F.filter(F.zip_with(x, F.slice(before, F.lit(1), F.size(x)), lambda y, at: F.when(y["s"] >= at, y)), lambda y: y.isNotNull()), lambda y: F.struct(y["s"].alias("s"), y["e"].alias("e"), y["kind"].alias("kind"), y["m"].alias("m")))

    keyed = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("o"), x["e"].alias("e"), x["kind"].alias("kind"), x["m"].alias("m")))
    return bound(F.array_sort(keyed), lambda x: F.when(F.size(x) > 0, taken(x)).otherwise(F.expr(f"cast(array() as array<{SPAN}>)")))


def join_spans(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(kinds) for x in (k, i)])
    keyed = F.transform(spans, lambda x: F.struct(x["s"], order[x["kind"]].alias("o"), x["e"], x["kind"]))
    return F.array_join(F.transform(F.array_sort(keyed), lambda x: F.concat_ws(":", x["kind"], x["s"], x["e"])), ",")


def redact(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with every run of overlapping or touching ``spans`` replaced by ``mask``; unchanged where there is none.

    Cuts one array of code points between running ends, so work follows the text and its spans.
    """

    def masked(x: Column) -> Column:
        ends = scan(x["at"], -1, lambda at, y: F.greatest(at, y["e"]))
        return bound(F.struct(F.concat(F.array(F.lit(-1)), ends).alias("ends"), F.split(x["t"], "").alias("chars"), x["at"].alias("at")), pieces)

    def pieces(x: Column) -> Column:
        cut = lambda a, b: F.array_join(F.slice(x["chars"], F.greatest(a, F.lit(0)) + 1, b - F.greatest(a, F.lit(0))), "")
        kept = F.zip_with(F.slice(x["ends"], F.lit(1), F.size(x["at"])), x["at"], lambda a, y: F.when(y["s"] > a, F.concat(cut(a, y["s"]), F.lit(mask))).otherwise(""))
        tail = F.element_at(x["ends"], -1)
        return F.concat(F.array_join(kept, ""), cut(tail, F.greatest(F.size(x["chars"]), tail)))

    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    return bound(F.struct(text.alias("t"), ordered.alias("at")), lambda x: F.when(F.size(x["at"]) > 0, masked(x)).otherwise(x["t"]))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (a, b): rows (node, component) with the smallest node of each component.

    Alternates large-star and small-star until the edges stop changing: a number of rounds logarithmic in the number of
    nodes. Each round shuffles edges only, takes minima by partial aggregation (no neighbour list is ever gathered) and
    is written to the shared folder, so a hub with a third of the edges is a skewed join that Spark may split.
    """

    def star(e: DataFrame, large: bool) -> DataFrame:
        if large:
            e = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = e.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        near = e.join(low, "a")
        if large:
            return near.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(low.select("a", F.col("m").alias("b")))

    now = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = None
    for _ in range(max_rounds):
        large = durable(star(now, True).where("a <> b").distinct())
        small = durable(star(large, False).where("a <> b").distinct())
        spent(now, large)
        now = small
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    low = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    out = durable(low.union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
    spent(now)
    return out
