"""Repair of conversation structure: min-plus transfer matrices over a grammar of role and fault sequences."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitgraph.llm.common import durable, runs, spent

#: States of a repaired conversation: nothing yet, after its system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
ROLES = "sua"
#: Where a row of the initial s, u or a may follow, and what state it makes.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: Symbols: four kinds of initial (other last), whole or truncated; rows that must go; rows the damage dropped.
GONE, ABSENT = 8, 9
FAR = 1 << 60
#: Rows a segment holds at most, and rows that share a grammar.
LENGTH, BLOCK = 1 << 16, 1 << 19
SEGMENT = "c string, part int, seq int, symbols binary, turns array<long>, unset array<boolean>, roles array<string>, hashes array<binary>, blank long, duplicate long, truncated long, illegal long, head string, tail string, low long, high long, turned long, matrix binary"
SOLVED = "c string, part int, seq int, entry int, leaves int, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
SPELLED = "c string, part int, seq int, audit string, at array<int>, turns array<long>, unset array<boolean>, roles array<string>, hashes array<binary>, becomes array<string>"


class Matrix:
    """What a run of rows costs between two states, and the rank of its cheapest audit among those from that state.

    Entries are (cost, rank): the audits from one state to different states never begin alike, so a product's ties are
    settled by the ranks of the left side, then of the right, and no text is compared. ``via`` is the rope: the state
    between both sides of a rule.
    """

    __slots__ = ("cost", "rank", "via", "sides")

    def __init__(self, cost: list, rank: list, via: list | None = None, sides: tuple | None = None):
        self.cost, self.rank, self.via, self.sides = cost, rank, via, sides


def ranked(keys: list) -> list[int]:
    """Places of comparable keys (None: no way) in order."""
    order = sorted((k, q) for q, k in enumerate(keys) if k is not None)
    out = [4] * len(keys)
    for place, (_, q) in enumerate(order):
        out[q] = place
    return out


def times(x: Matrix, y: Matrix) -> Matrix:
    """The min-plus product; the cheapest, then the ASCII-least audit wins."""
    cost, rank, via = [], [], []
    for p in range(4):
        row, keys, mid = [FAR] * 4, [None] * 4, [0] * 4
        for q in range(4):
            best = None
            for r in range(4):
                c = x.cost[p][r] + y.cost[r][q]
                if c < FAR and (best is None or (c, x.rank[p][r]) < best[:2]):
                    best = c, x.rank[p][r], r
            if best:
                row[q], mid[q] = best[0], best[2]
                keys[q] = best[1], y.rank[best[2]][q]
        cost.append(row)
        rank.append(ranked(keys))
        via.append(mid)
    return Matrix(cost, rank, via, (x, y))


def leaf(edits: list[dict[int, tuple[int, str]]]) -> Matrix:
    """A matrix from each state's ways: {state reached: (cost, audit)}."""
    cost = [[e[q][0] if q in e else FAR for q in range(4)] for e in edits]
    rank = [ranked([e[q][1] if q in e else None for q in range(4)]) for e in edits]
    return Matrix(cost, rank, [[e[q][1] if q in e else "" for q in range(4)] for e in edits])


def insertions() -> list[dict[int, tuple[int, str]]]:
    """No, one or two inserted rows (more lead nowhere new)."""
    out = []
    for p in range(4):
        ways = {p: (0, "")}
        for n in (1, 2):
            for roles in product("ua", repeat=n):
                at = p
                for x in roles:
                    at = STEPS[x].get(at)
                    if at is None:
                        break
                else:
                    ways.setdefault(at, (INSERT * n, "I" * n))
        out.append(ways)
    return out


def symbol_matrix(symbol: int) -> Matrix:
    """Insertions, then one row's edit: keep, rerole, delete."""
    if symbol == ABSENT:
        return leaf([{p: (0, "")} for p in range(4)])
    kind, extra = symbol % 4, TRUNCATED if 4 <= symbol < 8 else 0
    out = []
    for before in insertions():
        best: dict[int, tuple[int, str]] = {}
        for p, (paid, audit) in before.items():
            ways = [(p, DELETE, "D")]
            if symbol != GONE:
                ways += [(STEPS[x][p], REROLE + extra, "R") for x in "ua" if p in STEPS[x]]
                if kind < 3 and p in STEPS[ROLES[kind]]:
                    ways.append((STEPS[ROLES[kind]][p], extra, "K"))
            for q, c, letter in ways:
                best[q] = min(best.get(q, (FAR, "")), (paid + c, audit + letter))
        out.append(best)
    return leaf(out)


LAST = leaf(insertions())


def audit_of(m: Matrix, p: int, q: int) -> str:
    """The rope from state ``p`` to ``q`` spelled out."""
    out, todo = [], [(m, p, q)]
    while todo:
        m, p, q = todo.pop()
        if m.sides is None:
            out.append(m.via[p][q])
        else:
            r = m.via[p][q]
            todo += [(m.sides[1], r, q), (m.sides[0], p, r)]
    return "".join(out)


def re_pair(runs: list[np.ndarray], most: int = 512) -> tuple[list[np.ndarray], list[tuple[int, int]]]:
    """Re-Pair over all ``runs`` together: the most frequent pair of neighbours becomes a symbol, again and again.

    Gives the runs in the new symbols and the rules, numbered from ``ABSENT`` + 1; at most ``most`` rules, and none for
    a pair met once. Any grammar spells the same runs: the bound limits the saving, not the result.
    """
    x = np.concatenate([np.append(r, -1) for r in runs]).astype(np.int64) if runs else np.zeros(0, np.int64)
    rules: list[tuple[int, int]] = []
    base = ABSENT + 1 + most
    while len(rules) < most and len(x) > 1:
        good = np.flatnonzero((x[:-1] >= 0) & (x[1:] >= 0))
        if not len(good):
            break
        count = np.bincount(x[good] * base + x[good + 1])
        pair = int(count.argmax())
        if count[pair] < 2:
            break
        a, b = divmod(pair, base)
        at = good[(x[good] == a) & (x[good + 1] == b)]
        if a == b:  # of a row of equal symbols every other pair
            start = np.flatnonzero(np.concatenate(([True], np.diff(at) > 1)))
            place = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            at = at[place % 2 == 0]
        rules.append((a, b))
        x[at] = ABSENT + len(rules)
        x = np.delete(x, at + 1)
    ends = np.flatnonzero(x < 0)
    return [x[a:z] for a, z in zip(np.concatenate(([0], ends[:-1] + 1)) if len(ends) else [], ends, strict=True)], rules


def matrices(rules: list[tuple[int, int]]) -> list[Matrix]:
    """Each symbol's matrix, bottom-up: one product a rule, shared by all conversations that hold it."""
    out = [symbol_matrix(s) for s in range(ABSENT + 1)]
    for a, b in rules:
        out.append(times(out[a], out[b]))
    return out


def product_of(symbols: np.ndarray, of: list[Matrix]) -> Matrix:
    """The matrix of a run, halved again and again so that ropes stay shallow."""
    level = [of[s] for s in symbols.tolist()] or [of[ABSENT]]
    while len(level) > 1:
        level = [times(*level[i : i + 2]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


def evaluated(runs: list[np.ndarray]) -> list[Matrix]:
    """The matrices of all ``runs`` by one grammar; equal runs share one."""
    short, rules = re_pair(runs)
    of, known = matrices(rules), {}
    out = []
    for r in short:
        key = r.tobytes()
        if key not in known:
            known[key] = product_of(r, of)
        out.append(known[key])
    return out


def to_bytes(m: Matrix) -> bytes:
    return np.array(m.cost, "<i8").tobytes() + np.array(m.rank, np.int8).tobytes()


@lru_cache(100_000)
def known(raw: bytes) -> Matrix:
    """``from_bytes``, each matrix once: most conversations are like others."""
    return from_bytes(raw)


def stretches(keys: pd.Series) -> Iterator[tuple[str, int, int]]:
    """(key, from, to) of the runs of equal keys."""
    x = keys.to_numpy()
    cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
    for a, z in zip(cuts, cuts[1:]):
        if z > a:
            yield x[a], a, z


def from_bytes(raw: bytes) -> Matrix:
    return Matrix(np.frombuffer(raw[:128], "<i8").reshape(4, 4).tolist(), np.frombuffer(raw[128:], np.int8).reshape(4, 4).tolist())


def damage(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text, present) after a fixed damage by crc32(``conv_id:turn``) % 20; nulls are one space.

    0 drops a row (not ``present``), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4 makes it the user's.
    """
    word = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    d = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), word(role_col).alias("role"), word(text_col).alias("text"), (F.crc32(F.concat(word(conv_col), F.lit(":"), word(turn_col)).cast("binary")) % 20).alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")
    return d.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fault") != 0).alias("present"), copies).drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``c``, a conversation's name that is never null, and ``h``, its text's hash."""
    c = F.when(F.col("conv_id").isNull(), "n").otherwise(F.concat(F.lit("v"), F.col("conv_id").cast("string")))
    return rows.withColumn("c", c).withColumn("h", F.unhex(F.sha2("text", 256)))


def segments_of(rows: DataFrame) -> DataFrame:
    """Conversations as segments of rows in order, each with its counts and transfer matrix.

    Rows are range-sorted by (conversation, turn, role, text hash), so one conversation may lie in many partitions; what
    was said before, anywhere in it, is found by a join on its first turn.
    """
    bare = F.expr("rtrim(concat(' ', char(9), char(10), char(11), char(12), char(13)), text)")
    slim = rows.select("c", F.coalesce("turn", F.lit(0)).alias("turn"), F.col("turn").isNull().alias("unset"), "role", "h", "present", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("truncated"))
    again = slim.where("present").groupBy("c", "role", "h").agg(F.count("*").alias("times"), F.max("unset").alias("any_unset"), F.min("turn").alias("lowest"))
    again = again.where("times > 1").drop("times")
    slim = slim.join(again, ["c", "role", "h"], "left").withColumn("first", F.expr("any_unset is null or (any_unset and unset) or (not any_unset and turn = lowest)"))
    order = ["c", F.desc("unset"), "turn", "role", "h"]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = slim.drop("any_unset", "lowest").repartitionByRange(n, *order).sortWithinPartitions(*order)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        here, seq, before, held, size = TaskContext.get().partitionId(), 0, None, [], 0

        def segment(c: str, turns: list, unset: list, roles: list, hashes: list, flags: zip) -> list:
            nonlocal seq, before
            symbols, counts, kinds, seen = bytearray([ABSENT]) * len(turns), [0, 0, 0], [], []
            for i, (present, blank, cut, first) in enumerate(flags):
                if not present:
                    continue
                row = c, unset[i], turns[i], roles[i], hashes[i]
                repeated, before = not first or row == before, row
                kind = ROLES.find(roles[i][:1]) if roles[i] else -1
                kinds.append(ROLES[kind] if kind >= 0 else "x")
                if not unset[i]:
                    seen.append(turns[i])
                if blank or repeated or cut:
                    counts[0 if blank else 1 if repeated else 2] += 1
                symbols[i] = GONE if blank or repeated else (kind if kind >= 0 else 3) + (4 if cut else 0)
            illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
            seq += 1
            return [c, here, seq, bytes(symbols), turns, unset, roles, hashes, *counts, illegal, kinds[0] if kinds else None, kinds[-1] if kinds else None, seen[0] if seen else None, seen[-1] if seen else None, len(set(seen))]

        def flushed() -> pd.DataFrame:
            found = evaluated([np.frombuffer(s[3], np.uint8) for s in held])
            out = pd.DataFrame([[*s, to_bytes(m)] for s, m in zip(held, found, strict=True)], columns=[x.split()[0] for x in SEGMENT.split(", ")])
            return out.astype({"low": "Int64", "high": "Int64"})

        for frame in runs(parts, ["c"], LENGTH):
            cols = [frame[k].tolist() for k in ("turn", "unset", "role", "h", "present", "blank", "truncated", "first")]
            for c, a, z in stretches(frame["c"]):
                for at in range(a, z, LENGTH):
                    part = [col[at : min(at + LENGTH, z)] for col in cols]
                    held.append(segment(c, *part[:4], zip(*part[4:], strict=True)))
                    size += len(part[0])
            if size >= BLOCK:
                yield flushed()
                held, size = [], 0
        if held:
            yield flushed()

    return slim.mapInPandas(run, SEGMENT)


def solved(segments: DataFrame) -> DataFrame:
    """For each segment the states in which the cheapest repair enters and leaves it; on a conversation's last, its sums."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in runs(parts, ["c"]):
            out = []
            cols = {k: frame[k].tolist() for k in ("part", "seq", "blank", "duplicate", "truncated", "illegal", "head", "tail", "turned")}
            cols |= {k: frame[k].astype("Int64").tolist() for k in ("low", "high")}
            for c, a, z in stretches(frame["c"]):
                x = {k: col[a:z] for k, col in cols.items()}
                mats = [from_bytes(m) for m in frame["matrix"].iloc[a:z]] if z - a > 1 else [known(frame["matrix"].iat[a])]
                so_far = [mats[0]]
                for m in mats[1:]:
                    so_far.append(times(so_far[-1], m))
                whole = times(so_far[-1], LAST)
                cost, _, end = min((whole.cost[START][q], whole.rank[START][q], q) for q in ENDS)
                at, states = whole.via[START][end], []
                for m in reversed(so_far):
                    states.append(at)
                    at = m.via[START][at] if m.sides else START
                states = [START, *states[::-1]]
                illegal, distinct, tail, low, high = sum(x["illegal"]), sum(x["turned"]), None, None, None
                for first, last, lo, hi in zip(x["head"], x["tail"], x["low"], x["high"], strict=True):
                    if first is not None:
                        illegal += tail is not None and tail + first not in ("su", "ua", "au")
                        tail = last
                    if lo is not pd.NA:
                        distinct -= high is not None and lo == high
                        low, high = lo if low is None else low, hi
                gaps = high - low + 1 - distinct if low is not None else 0
                sums = [gaps, sum(x["blank"]), sum(x["duplicate"]), sum(x["truncated"]), illegal, cost]
                for i, (part, seq) in enumerate(zip(x["part"], x["seq"], strict=True)):
                    last = i + 1 == z - a
                    out.append([c, part, seq, states[i], states[i + 1], last, *(sums if last else [0] * 6)])
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SOLVED.split(", ")])

    slim = segments.select("c", "part", "seq", "matrix", "blank", "duplicate", "truncated", "illegal", "head", "tail", "low", "high", "turned")
    return slim.repartition("c").sortWithinPartitions("c", "part", "seq").mapInPandas(run, SOLVED)


def spelled(segments: DataFrame, states: DataFrame) -> DataFrame:
    """Each segment's part of the audit, and the rows that stay or come in: place, source row, new role."""
    both = segments.select("c", "part", "seq", "symbols", "turns", "unset", "roles", "hashes").join(states.select("c", "part", "seq", "entry", "leaves", "last"), ["c", "part", "seq"])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in parts:
            out = []
            found = evaluated([np.frombuffer(s, np.uint8) for s in x["symbols"]])
            for m, c, part, seq, symbols, turns, unset, roles, hashes, entry, leaves, last in zip(found, x["c"], x["part"], x["seq"], x["symbols"], x["turns"], x["unset"], x["roles"], x["hashes"], x["entry"], x["leaves"], x["last"], strict=True):
                audit = audit_of(m, entry, leaves)
                if last:
                    audit += min((LAST.cost[leaves][q], LAST.via[leaves][q]) for q in ENDS)[1]
                at, i, state, lines = 0, 0, entry, []
                for letter in audit:
                    if letter != "I":
                        while symbols[i] == ABSENT:
                            i += 1
                    if letter == "K":
                        state, becomes = STEPS[ROLES[symbols[i] % 4]][state], roles[i]
                    elif letter != "D":
                        state = USER if state != USER else ASSISTANT
                        becomes = "user" if state == USER else "assistant"
                    if letter != "D":
                        lines.append((at, turns[i], unset[i], roles[i], hashes[i], becomes) if letter != "I" else (at, 0, True, None, None, becomes))
                    i += letter != "I"
                    at += 1
                out.append([c, part, seq, audit, *(list(col) for col in (zip(*lines, strict=True) if lines else [[]] * 6))])
            yield pd.DataFrame(out, columns=[x.split()[0] for x in SPELLED.split(", ")])

    return both.mapInPandas(run, SPELLED)


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of every conversation: its audit, and the repaired rows.

    ``rows`` has conv_id, turn (long), role, text and present (boolean; a conversation is listed for its absent rows
    too). A conversation's rows count by turn, nulls first; those of one turn by role, then by their text's hash, as no
    other order is given. A null role or text is one space, a null conv_id one conversation; other columns are ignored.

    First: (c, conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit). Second: (c, conv_id, part, seq, at,
    role, text), in order of part, seq, at. Costs: keep 0, rerole 1, delete 2 (a must for blank and repeated rows), insert
    an empty row 5, leave a truncated one 5. The rows left have initials ``(s?(ua)+)?``; among equal costs the audit
    that is least in ASCII wins.

    A row is one of ten symbols. Segments of conversations, wherever a range partition ends, are rewritten by one
    Re-Pair grammar a block; each rule has one transfer matrix; segments' matrices are multiplied by conversation.
    Texts are hashed where they lie and move once, to the rows that stay.
    """
    blank = F.lit(" ")
    rows = keyed(rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), F.coalesce("present", F.lit(True)).alias("present")))
    segments = durable(segments_of(rows))
    states = durable(solved(segments))
    out = durable(spelled(segments, states))
    spent(segments)
    conv_id = F.when(F.col("c") == "n", F.lit(None)).otherwise(F.substring("c", 2, 1 << 30)).cast(rows.schema["conv_id"].dataType).alias("conv_id")
    audits = out.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))).alias("a"))
    audits = audits.select("c", F.array_join(F.transform("a", lambda x: x["audit"]), "").alias("audit"))
    summary = states.where("last").join(audits, "c").select("c", conv_id, "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    lines = out.select("c", "part", "seq", F.explode(F.arrays_zip("at", "turns", "unset", "roles", "hashes", "becomes")).alias("x"))
    lines = lines.select("c", "part", "seq", "x.at", F.expr("if(x.unset, null, x.turns)").alias("turn"), F.col("x.roles").alias("was"), F.col("x.hashes").alias("h"), F.col("x.becomes").alias("role"))
    none = lambda kind: F.lit(None).cast(kind)
    said = rows.where("present").select("c", "turn", F.col("role").alias("was"), "h", none("int").alias("part"), none("int").alias("seq"), none("int").alias("at"), none("string").alias("role"), "text")
    stays = lines.where("h is not null").select("c", "turn", "was", "h", "part", "seq", "at", "role", none("string").alias("text"))
    stays = said.union(stays).groupBy("c", "turn", "was", "h").agg(*(F.max(x).alias(x) for x in ("part", "seq", "at", "role", "text"))).where("at is not null")
    inserted = lines.where("h is null").select("c", "part", "seq", "at", "role", F.lit("").alias("text"))
    return summary, stays.select("c", "part", "seq", "at", "role", "text").union(inserted).select("c", conv_id, "part", "seq", "at", "role", "text")


def digests(repaired: DataFrame) -> DataFrame:
    """(c, repaired_sha256): the hash of a conversation's ``role:text`` lines, read in order; a task holds one hash state.

    A hash has no parts that could be joined, so the lines of one conversation pass through one task, as a stream.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for part in parts:
            done = []
            for c, role, text in zip(part["c"], part["role"], part["text"], strict=True):
                if c != now:
                    if state:
                        done.append((now, state.hexdigest()))
                    now, state = c, hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{role}:{text}".encode())
            yield pd.DataFrame(done, columns=["c", "repaired_sha256"])
        if state:
            yield pd.DataFrame([(now, state.hexdigest())], columns=["c", "repaired_sha256"])

    lines = repaired.select("c", "part", "seq", "at", "role", "text").repartition("c").sortWithinPartitions("c", "part", "seq", "at")
    return lines.select("c", "role", "text").mapInPandas(run, "c string, repaired_sha256 string")


def op11_repair(spark, sf_dir):
    summary, repaired = repair_conversations(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")))
    empty = hashlib.sha256().hexdigest()
    return summary.join(digests(repaired), "c", "left").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
