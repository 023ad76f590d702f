"""Conversation repair against a search over single rows."""

import hashlib
import heapq
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from visitgraph.llm import repair
from visitgraph.llm.repair import op11_repair

WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def cheapest(rows):
    """(cost, audit, lines) of rows (role, text, must go, truncated): Dijkstra over (row, last initial), letters tried in order."""
    todo, done = [(0, "", 0, "", ())], set()
    while todo:
        cost, audit, i, last, lines = heapq.heappop(todo)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, lines
        if (i, last) in done:
            continue
        done.add((i, last))
        for x, name in (("u", "user"), ("a", "assistant")):
            if x in NEXT[last]:
                heapq.heappush(todo, (cost + 5, audit + "I", i, NEXT[last][x], (*lines, f"{name}:")))
                if i < len(rows) and not rows[i][2]:
                    heapq.heappush(todo, (cost + 1 + 5 * rows[i][3], audit + "R", i + 1, NEXT[last][x], (*lines, f"{name}:{rows[i][1]}")))
        if i < len(rows):
            heapq.heappush(todo, (cost + 2, audit + "D", i + 1, last, lines))
            if not rows[i][2] and rows[i][0][:1] in NEXT[last]:
                heapq.heappush(todo, (cost + 5 * rows[i][3], audit + "K", i + 1, NEXT[last][rows[i][0][:1]], (*lines, f"{rows[i][0]}:{rows[i][1]}")))


def plain(table):
    """The query's rows by reading one conversation after another."""
    out, by = [], {}
    for conv, turn, role, text in table:
        rows = by.setdefault(conv, [])
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else text.translate({ord(c): None for c in ".!?"}) if fault == 2 else text
        rows += [(turn is not None, turn or 0, "user" if fault == 4 else role, hashlib.sha256(text.encode()).digest(), text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    for conv, rows in by.items():
        rows.sort()
        seen, kinds, counts, todo = set(), [], [0, 0, 0], []
        for _, _, role, _, text in rows:
            bare = text.strip(WHITE)
            faults = [not bare, (role, text) in seen, bool(bare) and bare[-1] not in ".!?"]
            if any(faults):
                counts[faults.index(True)] += 1
            seen.add((role, text))
            kinds.append(role[:1])
            todo.append((role, text, faults[0] or faults[1], faults[2]))
        turns = [t for known, t, *_ in rows if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:]))
        cost, audit, lines = cheapest(todo)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


def compare(spark, tmp_path, table):
    spark.createDataFrame(table, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS c", "2 AS present", "3 AS h").repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, op11_repair(spark, str(tmp_path)).collect()), key=repr)
    assert got == sorted(plain(table), key=repr)


def test_given_table(spark):
    path = "/root/testdata/sf0.001"
    table = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, op11_repair(spark, path).collect()), key=repr) == sorted(plain(table), key=repr)


def test_odd_rows(spark, tmp_path):
    """Nulls, repeated rows and turns, unknown roles, white space, and one conversation over all partitions."""
    rng = np.random.default_rng(3)
    roles, texts = ["user", "assistant", "system", None, "", "tool", "Ua"], ["Yes.", "Yes", "", None, " \n\x0b", "No!\n ", "no?", "é…", "a" * 3000 + "."]
    small = [(int(c) if c else None, None if t == 9 else int(t), roles[a], texts[b]) for c, t, a, b in zip(rng.integers(0, 60, 500), rng.integers(0, 10, 500), rng.integers(0, 7, 500), rng.integers(0, 9, 500), strict=True)]
    hot = [(77, int(t), roles[a], f"{texts[b]}{i % 50}." if i % 3 else texts[b]) for i, (t, a, b) in enumerate(zip(rng.integers(-5, 700, 900), rng.integers(0, 3, 900), rng.integers(0, 9, 900), strict=True))]
    compare(spark, tmp_path, small + hot + small[:40] + [(78, 4, "user", "same.")] * 30)


def test_short_segments(spark, tmp_path, monkeypatch):
    """Cuts between segments change nothing (in this process: the matrices' products)."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        row = rng.integers(0, 10, rng.integers(1, 40)).astype(np.uint8)
        whole = repair.evaluated([row])[0]
        cut = int(rng.integers(0, len(row) + 1))
        both = repair.times(repair.product_of(row[:cut], repair.matrices([])), repair.product_of(row[cut:], repair.matrices([])))
        assert (whole.cost, whole.rank) == (both.cost, both.rank)
        assert all(repair.audit_of(whole, p, q) == repair.audit_of(both, p, q) for p in range(4) for q in range(4) if whole.cost[p][q] < repair.FAR)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=30), max_size=6))
def test_grammar_spells_its_runs(lists):
    runs = [np.array(x, np.uint8) for x in lists]
    short, rules = repair.re_pair(runs)

    def spell(s):
        return [int(s)] if s <= repair.ABSENT else [y for x in rules[s - repair.ABSENT - 1] for y in spell(x)]

    assert [[y for s in r for y in spell(s)] for r in short] == lists


def test_no_rows(spark, tmp_path):
    compare(spark, tmp_path, [])
