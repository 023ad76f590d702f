"""Phrase collocations, counted in counting quotient filters over packed word ids."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitgraph.llm.common import durable, spent

LONGEST = 4
#: What ends a piece becomes byte 255, which no UTF-8 text has; A-Z are lower-cased.
_PLAIN = bytes.maketrans(b".,;:!?\n\x0b\x0c\r" + bytes(range(65, 91)), b"\xff" * 10 + bytes(range(97, 123)))
_ROUNDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)
STORED = "shard long, lang string, ids binary, local int, word string, n long"
FILTERS = "n int, bucket long, filter binary, shard long, ids binary"


def permuted(hi: np.ndarray, lo: np.ndarray, width: int, back: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """An invertible map of pairs of ``width``-bit numbers (at most 64 bits) onto themselves: four Feistel rounds.

    The first half of the image serves as quotient, the second is the full remainder, so counters lose nothing.
    """
    mask = np.uint64((1 << width) - 1)

    def mixed(x: np.ndarray, key: int) -> np.ndarray:
        x = (x + np.uint64(key)) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
        x *= np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(32))) & mask

    for key in reversed(_ROUNDS) if back else _ROUNDS:
        hi, lo = (lo ^ mixed(hi, key), hi) if back else (lo, hi ^ mixed(lo, key))
    return hi, lo


def tallied(q: np.ndarray, r: np.ndarray, width: int, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (quotient, remainder) pairs in order, with how often they come, or the sums of ``counts``."""
    if not len(q):
        return q, r, np.zeros(0, np.uint64)
    if 2 * width <= 64:
        key = (q << np.uint64(width)) | r
        order = np.argsort(key) if counts is not None else None
        key = np.sort(key) if order is None else key[order]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        q, r = key[first] >> np.uint64(width), key[first] & np.uint64((1 << width) - 1)
    else:
        order = np.lexsort((r, q))
        q, r = q[order], r[order]
        first = np.flatnonzero(np.concatenate(([True], (q[1:] != q[:-1]) | (r[1:] != r[:-1]))))
        q, r = q[first], r[first]
    if counts is None:
        return q, r, np.diff(np.append(first, len(order if order is not None else key))).astype(np.uint64)
    return q, r, np.add.reduceat(counts[order], first)


def _planes(x: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers as planes of equal-rank bytes, as many as the largest needs."""
    k = max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1
    return k, np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :k].T).tobytes()


def _from_planes(raw: bytes, k: int, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :k] = np.frombuffer(raw, np.uint8).reshape(k, n).T
    return out.reshape(-1).view("<u8")


def packed(ids: np.ndarray) -> bytes:
    k, raw = _planes(ids)
    return len(ids).to_bytes(8, "little") + bytes([k]) + raw


def ids_of(blob: bytes) -> np.ndarray:
    return _from_planes(blob[9:], blob[8], int.from_bytes(blob[:8], "little"))


def frozen(q: np.ndarray, r: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted filter as bytes: steps between quotients (mostly 0 or 1), full remainders, counts."""
    parts = [_planes(x) for x in (np.diff(q, prepend=np.uint64(0)), r, counts)]
    return len(q).to_bytes(8, "little") + bytes(k for k, _ in parts) + b"".join(raw for _, raw in parts)


def thawed(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, sizes, at, out = int.from_bytes(blob[:8], "little"), blob[8:11], 11, []
    for k in sizes:
        out.append(_from_planes(blob[at : at + k * n], k, n))
        at += k * n
    return np.cumsum(out[0], dtype=np.uint64), out[1], out[2]


def merged(blobs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted filters of one bucket made one: equal pairs' counts are added."""
    q, r, c = (np.concatenate(x) for x in zip(*map(thawed, blobs), strict=True))
    return tallied(q, r, width, c)


def slices(raw: bytes, least: int = 1 << 20) -> Iterator[bytes]:
    """A prepared text in parts that end where a piece does, each ``least`` bytes or more but for the last."""
    at = 0
    while at < len(raw):
        end = raw.find(b"\xff", at + least) if len(raw) - at > least else -1
        end = len(raw) if end < 0 else end + 1
        yield raw[at:end]
        at = end


class Shard:
    """Local word ids, from 1 in the order met, of some texts of one language."""

    def __init__(self, number: int, lang: str):
        self.number, self.lang, self.tokens = number, lang, 0
        self.known: defaultdict[bytes, int] = defaultdict()
        self.known.default_factory = self.known.__len__
        self.known[b"\xff"] = 0
        self.held, self.size, self.counts = [], 0, np.zeros(1, np.int64)

    def add(self, raw: bytes) -> None:
        words = raw.replace(b"\xff", b" \xff ").split()
        words.append(b"\xff")
        self.held.append(np.fromiter(map(self.known.__getitem__, words), np.uint32, len(words)))
        self.tokens += len(words)
        self.size += len(words)

    def row(self, least: int) -> Iterator[pd.DataFrame]:
        """The ids held so far as a row, if there are at least ``least``."""
        if not self.size or self.size < least:
            return
        x = np.concatenate(self.held)
        counts = np.bincount(x, minlength=len(self.known))
        counts[: len(self.counts)] += self.counts
        self.held, self.size, self.counts = [], 0, counts
        yield pd.DataFrame({"shard": [self.number], "lang": [self.lang], "ids": [packed(x)], "local": None, "word": None, "n": None})

    def words(self) -> Iterator[pd.DataFrame]:
        words = ["", *(w.decode() for w in list(self.known)[1:])]
        for a in range(1, len(words), 50_000):
            z = min(a + 50_000, len(words))
            yield pd.DataFrame({"shard": self.number, "lang": self.lang, "ids": None, "local": np.arange(a, z), "word": words[a:z], "n": self.counts[a:z]})


def encoded(docs: DataFrame, lang_col: str, text_col: str, shard_tokens: int) -> DataFrame:
    """One reading of all texts: rows of local word ids (0 ends a piece), and each shard's dictionary with counts.

    A shard is a stretch of one partition's texts of one language, of about ``shard_tokens`` words; only its dictionary
    and one row of ids are held.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 24
        shards: dict[str, Shard] = {}

        def closed(lang: str) -> Iterator[pd.DataFrame]:
            shard = shards.pop(lang)
            yield from shard.row(0)
            yield from shard.words()

        for part in parts:
            for lang, text in zip(part["lang"], part["text"], strict=True):
                for raw in slices((text or "").encode().translate(_PLAIN)):
                    if lang not in shards:
                        shards[lang] = Shard(number, lang)
                        number += 1
                    shards[lang].add(raw)
                    yield from shards[lang].row(1 << 18)
                    if shards[lang].tokens >= shard_tokens:
                        yield from closed(lang)
                if len(shards) > 64:
                    for other in list(shards):
                        yield from closed(other)
        for lang in list(shards):
            yield from closed(lang)

    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")).mapInPandas(run, STORED)


def windows(ids: np.ndarray, n: int, bits: int, pairs: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All runs of ``n`` known words, packed in two halves; ``pairs`` tells where a pair of words may be frequent."""
    if pairs is None:
        known = ids > 0
        good = known[: len(ids) - 1] & known[1:]
    else:
        good = pairs
    for _ in range(n - 2):
        good = good[:-1] & good[1:]
    at, b = np.flatnonzero(good), np.uint64(bits)
    if n == 2:
        return ids[at], ids[at + 1]
    lo = ids[at + 2] << b
    return ids[at] << b | ids[at + 1], lo | ids[at + 3] if n == 4 else lo


def filter_rows(n: int, ids: np.ndarray, bits: int, spread: int, pairs: np.ndarray | None = None) -> Iterator[tuple]:
    """(n, bucket, filter) of the runs of ``n`` words: the quotient's first ``spread`` bits are the bucket."""
    hi, lo = windows(ids, n, bits, pairs)
    width = bits if n == 2 else 2 * bits
    q, r, c = tallied(*permuted(hi, lo, width), width)
    if not len(q):
        return
    bucket = q >> np.uint64(max(0, width - spread))
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    for a, z in zip(cuts, np.append(cuts[1:], len(q)), strict=True):
        yield n, int(bucket[a]), frozen(q[a:z], r[a:z], c[a:z])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame([(*r, None, None) if len(r) == 3 else r for r in rows], columns=["n", "bucket", "filter", "shard", "ids"])


def kept(filters: DataFrame, bits: int, least: int, mark_bits: int) -> DataFrame:
    """Runs (n, w1 to w4, f) found ``least`` times or more: filters are merged by bucket, then unpacked.

    Buckets follow the permuted keys, so no run of words, however common, makes one large: a shard sends one counter.
    ``mark`` is a pair's place in the bitmap of frequent pairs.
    """

    def merge(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        n = int(key[0])
        width, b, mask = (bits if n == 2 else 2 * bits), np.uint64(bits), np.uint64((1 << bits) - 1)
        q, r, c = merged(part["filter"].tolist(), width)
        many = c >= np.uint64(least)
        q, r, c = q[many], r[many], c[many]
        hi, lo = permuted(q, r, width, back=True)
        zero = np.zeros(len(q), np.uint64)
        w = (hi, lo, zero, zero) if n == 2 else (hi >> b, hi & mask, lo >> b, lo & mask)
        out = pd.DataFrame({f"w{i + 1}": x.astype(np.int64) for i, x in enumerate(w)})
        out.insert(0, "n", np.int32(n))
        return out.assign(f=c.astype(np.int64), mark=place(q, r, bits, mark_bits) if n == 2 else np.int64(0))

    return filters.groupBy("n", "bucket").applyInPandas(merge, "n int, w1 long, w2 long, w3 long, w4 long, f long, mark long")


def place(q: np.ndarray, r: np.ndarray, bits: int, mark_bits: int) -> np.ndarray:
    return (((q << np.uint64(bits)) | r) >> np.uint64(max(0, 2 * bits - mark_bits))).astype(np.int64)


def bitmap(pairs: DataFrame, bits: int, mark_bits: int) -> np.ndarray:
    """The occupied quotients of frequent pairs, ``2**mark_bits`` bits at most whatever the input (8 MB at 26).

    An upper bound: runs it lets through are counted exactly; with very many pairs it only prunes less.
    """
    size = min(mark_bits, 2 * bits)
    low = min(15, size)

    def bitten(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros(1 << low, np.uint8)
        x[part["mark"].to_numpy() & ((1 << low) - 1)] = 1
        return pd.DataFrame({"part": [key[0]], "bits": [np.packbits(x, bitorder="little").tobytes()]})

    marks = pairs.select("mark", F.shiftright("mark", low).alias("part")).distinct()
    out = np.zeros((1 << (size - low), max(1, (1 << low) // 8)), np.uint8)
    for row in marks.groupBy("part").applyInPandas(bitten, "part long, bits binary").toLocalIterator():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def numbered(words: DataFrame) -> tuple[DataFrame, int]:
    """``words`` with dense numbers ``gid`` from 1, and how many there are. Written, as numbers must not change."""
    held = durable(words.withColumn("pid", F.spark_partition_id()))
    sizes = {r["pid"]: r["count"] for r in held.groupBy("pid").count().collect()}
    offsets, total = [], 0
    for pid, n in sorted(sizes.items()):
        offsets.append((pid, total))
        total += n
    starts = held.sparkSession.createDataFrame(offsets, "pid int, start long")
    at = F.row_number().over(Window.partitionBy("pid").orderBy("lang", "word")) + F.col("start")
    out = durable(held.join(F.broadcast(starts), "pid").select("lang", "word", "f", at.cast("long").alias("gid")))
    spent(held)
    return out, total


def mine_phrases(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 30, within: int = 80, top: int = 2000, shard_tokens: int = 1 << 21, mark_bits: int = 26) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to 4 words: lang, rank, phrase, a, l, r, n, score (all numbers long).

    Texts are lower-cased (A-Z) and split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and words at spaces and tabs. A phrase
    is a candidate if it comes ``least`` times or more; its score is the least over its cuts of
    floor(2000000 a / (l + r)), with the counts l and r of both sides (ties: the earliest cut). Candidates inside a
    longer candidate that comes at least ``within`` percent as often go. Ranked by score, then a (both descending),
    then phrase in byte order. All counts are exact, over all rows.

    Null texts are empty, a null language is ``und``; repeated rows count each; no rows give no rows; other columns are
    not read. Texts are read once, into shards of local word ids. Words that come ``least`` times get global numbers,
    which shards learn by a shuffle; pairs, then runs of 3 and 4 whose pairs may all be frequent, are counted in sorted
    counting quotient filters, merged across shards by quotient.
    """
    spark = docs.sparkSession
    store = durable(encoded(docs, lang_col, text_col, shard_tokens))
    words = store.where("word is not null")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    vocabulary, count = numbered(words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least))
    bits = max(1, count.bit_length())
    if bits > 32:
        raise ValueError("more than 2^32 frequent words")
    tokens = totals.agg(F.sum("n")).first()[0] or 0
    spread = max(6, (tokens >> 20).bit_length())

    def mapped(ids: pd.DataFrame, names: pd.DataFrame) -> pd.DataFrame:
        if not len(ids):
            return _frame([])
        local = names["local"].to_numpy(np.int64)
        rows, all_ids = [], [ids_of(x) for x in ids["ids"]]
        table = np.zeros(max(int(x.max()) if len(x) else 0 for x in all_ids) + 1, np.uint64)
        table[local] = names["gid"].to_numpy(np.uint64)
        found = [table[x.astype(np.int64)] for x in all_ids]
        rows += [(None, None, None, int(ids["shard"].iloc[0]), packed(x)) for x in found]
        rows += filter_rows(2, np.concatenate(found), bits, spread)
        return _frame(rows)

    local = words.select("shard", "lang", "word", "local").join(vocabulary, ["lang", "word"]).select(F.col("shard").alias("of"), "local", "gid")
    by_shard = store.where("ids is not null").select("shard", "ids").groupBy("shard").cogroup(local.groupBy("of")).applyInPandas(mapped, FILTERS)
    known = durable(by_shard)
    pairs = durable(kept(known.where("filter is not null").select("n", "bucket", "filter"), bits, least, mark_bits))
    marks = spark.sparkContext.broadcast(bitmap(pairs, bits, mark_bits))

    def longer(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        there, held, size = marks.value, [], 0

        def counted() -> pd.DataFrame:
            ids = np.concatenate(held)
            at = place(*permuted(ids[:-1], ids[1:], bits), bits, mark_bits)
            both = (ids[:-1] > 0) & (ids[1:] > 0) & (there[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0)
            return _frame([x for n in (3, 4) for x in filter_rows(n, ids, bits, spread, both)])

        for part in parts:
            for blob in part["ids"]:
                held.append(ids_of(blob))
                size += len(held[-1])
                if size >= shard_tokens:
                    yield counted()
                    held, size = [], 0
        if held:
            yield counted()

    runs = known.where("ids is not null").select("ids").mapInPandas(longer, FILTERS)
    more = durable(kept(runs.select("n", "bucket", "filter"), bits, least, mark_bits))
    spent(known)
    out = durable(ranked(pairs.unionByName(more), vocabulary, totals, within, top))
    spent(store, vocabulary, pairs, more)
    return out


def ranked(found: DataFrame, vocabulary: DataFrame, totals: DataFrame, within: int, top: int) -> DataFrame:
    """Scores, drops and ranks counted phrases (n, w1 to w4, f); a phrase's key is the array of its word numbers."""
    phrases = found.select(F.slice(F.array("w1", "w2", "w3", "w4"), F.lit(1), F.col("n")).alias("key"), "f")
    counts = phrases.unionByName(vocabulary.select(F.array("gid").alias("key"), "f"))
    size = F.size("key")
    cuts = phrases.select("key", "f", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("key", "f", "k", F.slice("key", F.lit(1), F.col("k")).alias("left"), F.slice("key", F.col("k") + 1, size - F.col("k")).alias("right"))
    cuts = cuts.join(counts.select(F.col("key").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    score = F.expr("cast(2000000 as decimal(7, 0)) * cast(f as decimal(19, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = cuts.groupBy("key").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"), F.first("f").alias("a"))
    inner = phrases.where(size > 2).select("f", "key", F.explode(F.sequence(F.lit(1), size - 1)).alias("from"))
    inner = inner.select("f", "key", "from", F.explode(F.sequence(F.lit(2), F.least(size - 1, size - F.col("from") + 1))).alias("long")).where(F.col("from") + F.col("long") - 1 <= F.size("key"))
    over = inner.groupBy(F.slice("key", F.col("from"), F.col("long")).alias("key")).agg(F.max("f").alias("most"))
    held = best.join(over, "key", "left").where(f"most is null or 100 * cast(most as decimal(25, 0)) < {within} * cast(a as decimal(25, 0))")
    named = held.select("key", F.posexplode("key").alias("at", "gid")).join(vocabulary.select("gid", "word", "lang"), "gid")
    named = named.groupBy("key").agg(F.first("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    out = held.join(named, "key").join(totals, "lang")
    out = out.select("lang", F.array_join(F.transform("words", lambda x: x["word"]), " ").alias("phrase"), "a", "best.l", "best.r", "n", "best.score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return out.withColumn("rank", rank.cast("long")).where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir):
    return mine_phrases(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: The same by plain counting of all runs.
OP12 = r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
u AS (SELECT lang, unnest(w) AS word FROM w),
n AS (SELECT lang, count(*) AS n FROM u GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3, 4]) AS k)),
c AS (SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS w FROM g GROUP BY lang, k, phrase HAVING count(*) >= 30),
cut AS (SELECT lang, k, phrase, f, unnest(range(1, k)) AS m, w FROM c WHERE k > 1),
s AS (
 SELECT x.lang, x.phrase, x.f AS a, x.m, l.f AS l, r.f AS r, CAST(2000000::HUGEINT * x.f // (l.f + r.f) AS BIGINT) AS score
 FROM cut x JOIN c l ON l.lang = x.lang AND l.phrase = array_to_string(x.w[1:x.m], ' ')
 JOIN c r ON r.lang = x.lang AND r.phrase = array_to_string(x.w[x.m + 1:x.k], ' ')),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, m) AS o FROM s) WHERE o = 1),
i AS (SELECT c.lang, c.f, c.w, j.a, j.z FROM c JOIN (VALUES (3, 1, 2), (3, 2, 3), (4, 1, 2), (4, 2, 3), (4, 3, 4), (4, 1, 3), (4, 2, 4)) j(k, a, z) ON j.k = c.k),
o AS (SELECT lang, array_to_string(w[a:z], ' ') AS phrase, max(f) AS most FROM i GROUP BY 1, 2),
q AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, n.n, b.score FROM best b JOIN n ON n.lang = b.lang LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase
 WHERE o.most IS NULL OR 100::HUGEINT * o.most < 80::HUGEINT * b.a)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM q) WHERE rank <= 2000
"""
