import hashlib
import hmac
from collections import defaultdict

import pytest

from tests.conftest import DATA
from visitgraph.plans import batches, dates, devices, files, index, matching, replies, review, reviews, scalar, voting

PLANS = {name: (f, plan.SQL[name]) for plan in (scalar, index, voting, matching, devices, dates, batches, review, reviews, replies, files) for name, f in plan.QUERIES.items() if name in plan.SQL}


@pytest.mark.parametrize("name", sorted(PLANS))
def test_query_equals_its_sql(name, same):
    same(*PLANS[name])


def test_receipts_equal_hmac(spark):
    texts = {r["doc_id"]: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for r in batches.QUERIES["keyed_receipts"](spark, DATA).collect():
        key = hashlib.sha256((texts[r["doc_id"]]["text"] or "").encode()).digest()
        assert r["task_receipt"] == hmac.new(key, f"task:{r['doc_id']}".encode(), "sha256").hexdigest()[:24]


def test_density_counts_positive_values(spark):
    v = batches.vector(spark.read.parquet(f"{DATA}/embeddings.parquet"))
    want = {r[0]: sum(x > 0 for x in r["e"]) / len(r["e"]) for r in v.collect()}
    for r in batches.QUERIES["content_density"](spark, DATA).collect():
        assert abs(r["density"] - want[r["id"]]) < 1e-6


def test_backoff_keeps_its_waits(spark):
    from visitgraph.operators.dispatch import backoff, step

    rows = [(1, i, f"2024-01-01 {m // 60:02}:{m % 60:02}:00", f, inp, False) for i, (m, f, inp) in enumerate([(0, "a", True), (10, "a", False), (20, "a", False), (50, "a", False), (60, "a", False), (65, "b", True), (66, "c", False), (90, None, False), (91, "c", False)])]
    d = spark.createDataFrame(rows, "queue long, event_id long, ts string, fingerprint string, has_input boolean, changed_later boolean").selectExpr("queue", "event_id", "cast(ts as timestamp) ts", "fingerprint", "has_input", "changed_later")
    got = [(r["action"], r["attempts"]) for r in backoff(d).orderBy("event_id").collect()]
    assert got == [("dispatch", 1), ("wait", 1), ("dispatch", 2), ("wait", 2), ("dispatch", 3), ("dispatch", 1), ("wait", 0), ("idle", 0), ("dispatch", 1)]
    by, out = defaultdict(list), {}
    for r in spark.read.parquet(f"{DATA}/events.parquet").collect():
        by[r["user_id"]].append(r)
    for q, events in by.items():
        state = (None, None, 0)
        for r in sorted(events, key=lambda r: (r["ts"], r["event_id"])):
            f = None if r["event_type"] == "signup" else str(int(r["value"] // 40))
            state, out[r["event_id"]] = step(state, r["ts"].timestamp(), f, r["event_type"] == "click", r["event_type"] == "error")
    assert {r["event_id"]: r["action"] for r in review.QUERIES["dispatch_backoff"](spark, DATA).collect()} == out
