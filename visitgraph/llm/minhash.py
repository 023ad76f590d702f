"""Near-duplicates by bottom-k sketches from one hash function, confirmed by exact Jaccard likeness."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.common import components, durable, runs, spent

#: Hashes retained of each document's set, its lowest ones.
K = 64
#: Bits of a document's code: a set's hashes fall into that many bins, and the lowest of each gives one bit.
BITS = 256
#: Odds of missing a link of exactly the likeness asked for, at each of the two probabilistic steps.
ODDS = 5e-9
#: Members of a list beyond which it is split: by size, then by a second common value, then into blocks.
HOT = 4096
#: Candidate pairs of a batch that a task holds; beyond these it works them out anew for each use.
PAIRS_HELD = 2_000_000
#: Documents, and shingles, of one side of a cell in which documents are compared exactly.
CELL_DOCS, CELL_SHINGLES = 512, 200_000
_P = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)
_BYTES = np.random.default_rng(20).integers(0, 2**64, 256, dtype=np.uint64)
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
CODE = [f"c{i}" for i in range(BITS // 64)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 63-bit hashes (so their order is the same as signed numbers) of the ``width``-word shingles of a whole text, ASCII letters lower-cased.

    A word's hash is a polynomial over per-byte random numbers, taken from prefix sums, so one pass over the bytes
    serves all words. Fewer words than ``width`` make one shingle; none make none.
    """
    global _POWERS
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass").translate(_LOWER), np.uint8)
    inside = np.concatenate(([False], ~_WHITE[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    longest = int((ends - starts).max())
    if len(_POWERS) < longest + 1:
        _POWERS = np.concatenate(([np.uint64(1)], np.cumprod(np.full(longest + 64, _P, np.uint64), dtype=np.uint64)))
    at = np.repeat(np.arange(len(starts)), ends - starts)
    place = np.arange(int((ends - starts).sum())) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    value = _BYTES[raw[inside[1:-1]]] * _POWERS[place]
    word = _mixed(np.add.reduceat(value, np.flatnonzero(np.diff(at, prepend=-1))) + (ends - starts).astype(np.uint64))
    width = min(width, len(word))
    n = len(word) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = _mixed(out * _P + word[i : i + n])
    return np.unique(out >> np.uint64(1))


def code_of(h: np.ndarray) -> np.ndarray:
    """``BITS`` bits of a sorted set, as whole numbers: by bin (the hash's low bits) a bit of the lowest hash there, 0 in empty bins."""
    bits = np.zeros(BITS, np.uint8)
    bins, first = np.unique(h & np.uint64(BITS - 1), return_index=True)
    bits[bins.astype(np.int64)] = (h[first] >> np.uint64(20)) & np.uint64(1)
    return np.packbits(bits).view(np.int64)


def sketches(docs: DataFrame, width: int, k: int = K) -> DataFrame:
    """(doc_id, n, h1, h2, sketch, c0..): set size, a 128-bit hash of the set, its ``k`` lowest hashes (their upper 32
    bits) and its code, for every row."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for t in part["text"]:
                h = shingle_hashes(t, width)
                rows.append((len(h), int(h.sum(dtype=np.uint64).astype(np.int64)), int(_mixed(h).sum(dtype=np.uint64).astype(np.int64)), (h[:k] >> np.uint64(31)).astype(np.uint32).view(np.int32), *code_of(h).tolist()))
            out = pd.DataFrame(rows, columns=["n", "h1", "h2", "sketch", *CODE])
            out.insert(0, "doc_id", part["doc_id"].astype("Int64").to_numpy(dtype=object, na_value=None) if len(part) else [])
            yield out

    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, n long, h1 long, h2 long, sketch array<int>, " + ", ".join(f"{c} long" for c in CODE))


def full_sets(docs: DataFrame, ids: DataFrame, width: int, bits: int = 2**23) -> DataFrame:
    """(id, hashes): the full shingle sets of the documents in ``ids`` (id).

    A bitmap of ``bits`` bits over hashed ids (1 MB, whatever the number of ids) is broadcast so that most other
    documents stay behind at the scan; an exact semi-join of the sets that pass takes out the rest.
    """
    spot = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    marks = ids.select(spot("id").alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("marks"))
    d = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("id IS NOT NULL").withColumn("p", spot("id")).withColumn("bucket", F.bitmap_bucket_number("p"))
    d = d.withColumn("bit", F.bitmap_bit_position("p").cast("int")).join(F.broadcast(marks), "bucket")
    d = d.where("shiftright(cast(conv(hex(substring(marks, shiftright(bit, 3) + 1, 1)), 16, 10) AS int), bit % 8) & 1 = 1").select("id", "text")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"id": part["id"], "hashes": [shingle_hashes(t, width).astype(np.int64) for t in part["text"]]})

    return d.mapInPandas(run, "id long, hashes array<long>").join(ids, "id", "left_semi").where("size(hashes) > 0")


def shown(likeness: float) -> int:
    """How many of the lowest values of a union hold a shared one, but for ``ODDS``, at that likeness."""
    return math.ceil(math.log(ODDS) / math.log(1 - likeness))


def postings(sets: DataFrame, likeness: float) -> DataFrame:
    """(key, cell, id, n, c0..): the inverted lists of the lowest retained values, cut into cells of bounded length.

    Two sets of likeness j share one of the m lowest values of their union but for (1 - j)^m, and that one is among the m
    lowest of both; so only m values (12 at 0.8) of each sketch are listed. A list of more than ``HOT`` members is cut by
    size, as alike sets are of the same or the next size class. One still longer is replaced by lists of two values, the
    common one and one of the m that follow it, which few unrelated documents share. What is still longer is cut into
    pairs of blocks, so that any two members meet in some cell and no cell grows with the input.
    """
    m = shown(likeness)
    code = ["id", "n", *CODE]

    def crowded(d: DataFrame) -> DataFrame:
        return durable(d.groupBy("key", "cell").agg(F.ceil(F.count("*") / HOT).cast("int").alias("parts")).where("parts > 1"))

    few = sets.select(*code, F.posexplode(F.slice("sketch", 1, m)).alias("at", "v")).select(F.col("v").cast("long").alias("key"), F.lit(0).alias("cell"), *code, "at")
    hot = crowded(few)
    size = F.floor(F.log("n") / math.log(1 / likeness) + 1e-9).cast("int")
    banded = few.join(hot.drop("parts"), ["key", "cell"], "left_semi").withColumn("cell", F.explode(F.array(size, size + 1)))
    hot_bands = crowded(banded)
    second = banded.join(hot_bands.drop("parts"), ["key", "cell"], "left_semi").select("key", "cell", "id", "n", "at")
    second = second.join(sets.select("sketch", *code), ["id", "n"]).select("key", "cell", *code, F.explode(F.slice("sketch", F.col("at") + 2, F.lit(m))).alias("w"))
    second = durable(second.select(F.xxhash64("key", "w").alias("key"), "cell", *code))
    crowds = crowded(second)
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    split = second.join(crowds, ["key", "cell"]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        few.join(hot, ["key", "cell"], "left_anti")
        .select("key", "cell", *code)
        .union(banded.join(hot_bands, ["key", "cell"], "left_anti").select("key", "cell", *code))
        .union(second.join(crowds, ["key", "cell"], "left_anti").select("key", "cell", *code))
        .union(split.select(F.xxhash64("key", "cell", F.least(own, "j"), F.greatest(own, "j")), F.lit(-1), *code))
    )


def candidate_edges(lists: DataFrame, likeness: float) -> DataFrame:
    """(a, b, far): per list, edges that join all members which may be alike, with the bits their codes differ in.

    A set's difference changes a bit of the code at most for each element, and at likeness j a bit differs with
    probability (1 - j) / 2, so codes further apart than both bounds allow (the second at the normal deviate of ``ODDS``)
    rule a pair out, as do sizes too unequal. Members with candidates name the one with the most candidates of all (a
    copy near the middle of its group), and groups that touch are joined by one edge: edges stay in proportion to members.
    """
    spread = math.sqrt(-2 * math.log(ODDS))
    most = BITS * (1 - likeness) / 2 + spread * math.sqrt(BITS * (1 - likeness) / 2 * (1 + likeness) / 2)
    part_of = (1 - likeness) / (1 + likeness)

    def edges(d: pd.DataFrame) -> pd.DataFrame:
        run = np.cumsum((d["key"].diff().ne(0) | d["cell"].diff().ne(0)).to_numpy())
        n, ids, code = d["n"].to_numpy(np.int64), d["id"].to_numpy(), d[CODE].to_numpy(np.int64).view(np.uint64)

        def pairs() -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """All candidate pairs, by their distance in the sorted run; no index comes twice on one side."""
            live = np.arange(len(d) - 1)
            for step in range(1, len(d)):
                live = live[live + step < len(d)]
                other = live + step
                near = (run[live] == run[other]) & (n[other] * likeness <= n[live] + 1e-9)
                live, other = live[near], other[near]
                if not len(live):
                    return
                off = np.bitwise_count(code[live] ^ code[other]).sum(axis=1, dtype=np.int64)
                alike = (off <= np.minimum(most, part_of * (n[live] + n[other]) + 1e-9)) & (ids[live] != ids[other])
                if alike.any():
                    yield live[alike], other[alike], off[alike]

        degree, kept = np.zeros(len(d), np.int64), []
        for i, j, off in pairs():
            degree[i] += 1
            degree[j] += 1
            if kept is not None:
                kept.append((i, j, off))
                kept = kept if degree.sum() <= PAIRS_HELD else None
        again = pairs if kept is None else lambda: kept
        rank = np.empty(len(d), np.int64)
        rank[np.lexsort((ids, -degree))] = np.arange(len(d))
        top, gap = np.arange(len(d)), np.zeros(len(d), np.int64)
        for i, j, off in again():
            for low, high in ((i, j), (j, i)):
                better = rank[high] < rank[top[low]]
                top[low[better]], gap[low[better]] = high[better], off[better]
        low = np.flatnonzero(top != np.arange(len(d)))
        out = [(low, top[low], gap[low])]
        while (up := top[top]).tobytes() != top.tobytes():
            top = up
        for i, j, off in again():
            while (apart := top[i] != top[j]).any():
                k = int(apart.argmax())
                out.append((i[k : k + 1], j[k : k + 1], off[k : k + 1]))
                top[top == top[j[k]]] = top[i[k]]
        a, b, off = (np.concatenate(x) for x in zip(*out, strict=True))
        return pd.DataFrame({"a": ids[a], "b": ids[b], "far": off}).astype("int64")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in runs(parts, ["key", "cell"]):
            yield edges(whole)

    dealt = lists.repartition("key", "cell").sortWithinPartitions("key", "cell", "n", "id")
    return dealt.mapInPandas(run, "a long, b long, far long").groupBy("a", "b").agg(F.min("far").alias("far"))


def confirmed(docs: DataFrame, sets: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose union sketch says they may be alike and whose full sets have 100 * shared >= percent * all."""
    s = sets.select("id", "n", "sketch")
    d = pairs.join(s.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
    d = d.join(s.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
    # where both sketches hold their whole sets, their whole union is counted and the figure is exact but for equal upper halves of hashes
    whole = (F.col("na") <= K) & (F.col("nb") <= K)
    union = F.slice(F.array_sort(F.array_union("sa", "sb")), F.lit(1), F.when(whole, 2 * K).otherwise(K))
    shared = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
    # elsewhere as many standard deviations below the threshold as the odds ask for
    margin = F.when(whole, 1 / K).otherwise(math.sqrt(-2 * math.log(ODDS)) * math.sqrt(percent / 100 * (1 - percent / 100) / K))
    d = durable(d.where(shared >= (percent / 100 - margin) * F.size(union) - 1e-9).select("a", "b").distinct())
    full = full_sets(docs, d.select(F.col("a").alias("id")).union(d.select("b")).distinct(), width)
    both = d.join(full.select(F.col("id").alias("a"), F.col("hashes").alias("ha")), "a").join(full.select(F.col("id").alias("b"), F.col("hashes").alias("hb")), "b")
    same = F.size(F.array_intersect("ha", "hb"))
    out = durable(both.where(100 * same >= percent * (F.size("ha") + F.size("hb") - same)).select("a", "b"))
    spent(d)
    return out


def links_between(docs: DataFrame, members: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): true links that join all components which ``members`` (id, cluster, c, n) of one cluster form.

    ``c`` is a member's component so far. Members outside their cluster's largest component meet all members of the
    cluster in cells of bounded size, a block of theirs and a block of all, where full sets are compared by counting
    shared shingles. A cell gives only links that join components, never all links of a group.
    """
    by = members.groupBy("cluster", "c").agg(F.count("*").alias("own"), F.sum("n").alias("load"))
    main = by.groupBy("cluster").agg(F.max(F.struct("own", F.col("c").alias("main"))).alias("top"), F.count("*").alias("parts"), F.sum("own").alias("size"), F.sum("load").alias("load"))
    main = durable(main.where("parts > 1 AND size > 2").select("cluster", "top.main", F.greatest(F.ceil(F.col("size") / CELL_DOCS), F.ceil(F.col("load") / CELL_SHINGLES)).cast("int").alias("blocks"), F.greatest(F.ceil((F.col("size") - F.col("top.own")) / CELL_DOCS), F.lit(1)).cast("int").alias("asks")))
    d = durable(members.join(main, "cluster"))
    asks = F.least("asks", "blocks")
    every = F.sequence(F.lit(0), asks - 1)
    rows = d.select("id", "cluster", "c", F.lit(False).alias("asking"), F.pmod(F.xxhash64("id"), "blocks").cast("int").alias("i"), F.explode(every).alias("j"))
    rows = rows.union(d.where("c <> main").select("id", "cluster", "c", F.lit(True), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), F.pmod(F.xxhash64("id", F.lit(1)), asks).cast("int")))
    sets = full_sets(docs, d.select("id").distinct(), width)

    def compare(g: pd.DataFrame) -> pd.DataFrame:
        asked, asking = g[~g["asking"]].reset_index(drop=True), g[g["asking"]].sort_values("id")
        top, out = {int(c): int(c) for c in g["c"]}, []
        if not len(asked) or not len(asking):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")

        def root(c: int) -> int:
            while top[c] != c:
                c = top[c] = top[top[c]]
            return c

        sizes = asked["hashes"].map(len).to_numpy()
        values, owner = np.concatenate(asked["hashes"].tolist()), np.repeat(np.arange(len(asked)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner, comp, ids = values[order], owner[order], asked["c"].tolist(), asked["id"].tolist()
        for x, c, h in zip(asking["id"].tolist(), asking["c"].tolist(), asking["hashes"], strict=True):
            h = np.asarray(h)
            lo, hi = np.searchsorted(values, h, "left"), np.searchsorted(values, h, "right")
            n = hi - lo
            at = np.arange(int(n.sum())) + np.repeat(lo - np.cumsum(n) + n, n)
            shared = np.bincount(owner[at], minlength=len(asked))
            for y in np.flatnonzero(100 * shared >= percent * (sizes + len(h) - shared)).tolist():
                a, b = root(int(c)), root(int(comp[y]))
                if a != b:
                    top[max(a, b)] = min(a, b)
                    out.append((x, ids[y]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    out = durable(rows.join(sets, "id").groupBy("cluster", "i", "j").applyInPandas(compare, "a long, b long"))
    spent(main, d)
    return out


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text; other columns are ignored).

    Documents are linked when 100 * |A and B| >= percent * |A or B| over their sets of ``width``-word shingles;
    component_id is the smallest doc_id reachable, kept tells whether it is the document's own.

    Equal sets collapse first (by partial aggregation), so copies are never paired. Inverted lists of the lowest sketch
    values (``postings``) give candidate edges in proportion to their members (``candidate_edges``); these split the
    documents into clusters outside which nothing may be alike. Each document's nearest candidate is filtered by the
    union of both sketches and confirmed on full sets; wherever a cluster then still holds several components, all
    members beyond its largest one are compared exactly with the whole cluster (``links_between``). So a group of near
    copies costs one pair a member, and a link is lost only by the odds stated: twice ``ODDS`` for a pair at exactly
    the threshold, less above; links found are exact.

    Texts without words, and null texts, are linked with nothing. Rows with a null doc_id have no name to be linked by:
    they keep a null component_id and are kept. Repeated rows share their result; where one doc_id has several texts,
    it has the links of all of them. An empty table gives an empty one.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    likeness = percent / 100
    rows = durable(sketches(docs, width))
    named = rows.where("n > 0 AND doc_id IS NOT NULL")
    same = durable(named.select("doc_id", "h1", "h2", "n").distinct())
    reps = durable(same.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("id")))
    sets = named.join(reps.withColumnRenamed("id", "doc_id"), ["h1", "h2", "n", "doc_id"]).dropDuplicates(["h1", "h2", "n"])
    sets = durable(sets.select(F.col("doc_id").alias("id"), "n", "sketch", *CODE))
    # a doc_id with several sets joins their representatives
    several = same.groupBy("doc_id").agg(F.count("*").alias("sets")).where("sets > 1").select("doc_id")
    own = durable(same.join(several, "doc_id", "left_semi").join(reps, ["h1", "h2", "n"]).where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct())

    edges = durable(candidate_edges(postings(sets, likeness), likeness))
    cluster = components(edges)
    nearest = edges.groupBy("a").agg(F.min_by("b", F.struct("far", "b")).alias("b"))
    links = confirmed(docs, sets, nearest, width, percent)
    label = components(links)
    members = cluster.select(F.col("node").alias("id"), F.col("component").alias("cluster")).join(label.withColumnRenamed("node", "id"), "id", "left").select("id", "cluster", F.coalesce("component", "id").alias("c"))
    members = members.join(sets.groupBy("id").agg(F.sum("n").alias("n")), "id")
    more = links_between(docs, members, width, percent)
    label_2 = components(links.union(more).union(own))
    spent(edges, cluster, links, label, more, own, sets)

    reach = reps.join(label_2.withColumnRenamed("node", "id"), "id", "left").select("h1", "h2", "n", F.coalesce("component", "id").alias("component"))
    out = rows.select("doc_id", "n", "h1", "h2").join(reach, ["h1", "h2", "n"], "left")
    out = durable(out.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")))
    spent(rows, same, reps, label_2)
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each near-duplicate group: that with the smallest doc_id; columns unchanged, whatever their names.

    Rows that repeat a kept doc_id stay with it; rows with a null doc_id are kept.
    """
    gone = near_duplicates(docs, width, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op9_minhash(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=2, percent=80)
