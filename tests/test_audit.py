"""The audit of cases: every pair once, rivals beyond a page told, and nothing moved once a pair."""

import random
from datetime import date, timedelta

import pytest

from visitgraph.operators import linkage as L
from visitgraph.operators import tables

CASES = "doc_id string, serials array<string>, phones array<string>, assets array<string>, sites array<string>, product string"
RECORDS = "gid string, name string, notes string, due date"


def text(s):
    return "".join(x for x in s.upper() if x.isascii() and x.isalnum())


def brute(cases, records, page):
    """What each case finds, by comparing all."""
    body = {g: text(n + "\n" + (t or "")) for g, n, t, _ in records}
    tokens = {g: {w for w in "".join(x if x.isascii() and x.isalnum() else " " for x in f"{n}\n{t or ''}".upper()).split() if len(w) >= 6} for g, n, t, _ in records}
    order = sorted(records, key=lambda r: (r[3] is None, -(r[3] or date.min).toordinal(), r[0]))
    out = []
    for doc, serials, phones, assets, sites, product in cases:
        clean = lambda a: [text(x) for x in a or [] if x and text(x)]
        serials, phones, assets, sites = map(clean, (serials, phones, assets, sites))
        found, full = {}, False
        for term in {*serials, *phones, *assets}:
            hits = [r for r in order if term in tokens[r[0]]]
            full |= len(hits) > page
            found |= {r[0]: r for r in hits[:page]}
        for g, name, _, due in found.values():
            digits = "".join(x for x in body[g] if x.isdigit())
            title = text(name)
            told = [("serial", any(x in body[g] for x in serials), 100), ("phone", any(x in digits for x in phones), 45), ("asset", any(x in digits for x in assets), 30), ("site", any(title.startswith(x) for x in sites), 20), ("product", bool(product) and text(product) in title, 15), ("recent", due is not None and due >= date(1998, 1, 1), 10)]
            out.append((doc, g, due, sum(n for _, x, n in told if x), ";".join(k for k, x, _ in told if x), full))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows", [500_000, 40])
@pytest.mark.parametrize("page", [3, 100])
def test_audit_equals_brute_force(spark, monkeypatch, page, rows):
    """Terms over and under a page, borne together and apart; null and empty values; with parts that follow the rows too."""
    monkeypatch.setattr(tables, "TASK_ROWS", rows)
    rng = random.Random(3)
    serial = [f"USN{i:06d}" for i in range(12)]
    number = [f"9{i:07d}" for i in range(9)]
    some = lambda a, k: [rng.choice([*a, None, ""]) for _ in range(rng.randint(0, k))] if rng.random() < 0.9 else None
    records = [(f"g{i}", f"{rng.choice(['QMH', 'North Site'])} / {rng.choice(['CX50', 'EPIQ 7'])} / {rng.choice(serial)}", rng.choice([None, f"Phone {rng.choice(number)} Contact: x Asset# {rng.choice(number)}"]), rng.choice([None, date(1997, 12, 1) + timedelta(rng.randint(0, 60))])) for i in range(60)]
    cases = [(f"d{i}", some(serial, 5), some(number, 5), some(number, 2), some(["QMH", "north site"], 2), rng.choice([None, "", "CX50"])) for i in range(80)]
    d = L.audit_cases(spark.createDataFrame(cases, CASES), spark.createDataFrame(records, RECORDS), "1998-01-01", page=page)
    got = [(r["doc_id"], r["gid"], r["due"], r["score"], r["reasons"], r["full"]) for r in d.collect()]
    want = brute(cases, records, page)
    assert sorted(got, key=repr) == want and {x[5] for x in want} == ({True, False} if page == 3 else {False})


def test_pairs_are_not_moved(spark, monkeypatch):
    """Cases and records are dealt by term alone, and what they give is written where they meet."""
    plans = []
    monkeypatch.setattr(L, "settled", lambda d: (plans.append(d._jdf.queryExecution().executedPlan().toString()), tables.settled(d))[1])
    records = [(f"g{i}", f"QMH / CX50 / USN{i // 40:06d}", "Phone 1", None) for i in range(400)]
    cases = [(f"d{i}", [f"USN{i // 40:06d}"], [], [], ["QMH"], "CX50") for i in range(400)]
    out = L.audit_cases(spark.createDataFrame(cases, CASES), spark.createDataFrame(records, RECORDS), "1998-01-01")
    assert out.count() == 400 * 40
    last = plans[-1]
    assert "ShuffledHashJoin" in last and "hashpartitioning(token" in last
    assert "hashpartitioning(doc_id" not in last and "hashpartitioning(gid" not in last
