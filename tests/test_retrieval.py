import random

from pyspark.sql import functions as F

from tests.conftest import DATA
from visitgraph.operators import linkage as L
from visitgraph.plans import devices


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def test_keys_within_edits_share_a_deletion(spark):
    got = spark.range(1).select(L.neighbours(F.lit("ABCD"), 3).alias("n"), L.neighbours(F.lit("A"), 3).alias("m")).first()
    assert {"ABCD", "ABC", "AD", "C"} <= set(got["n"]) and len(got["n"]) == 15 and set(got["m"]) == {"A", ""}


def test_retrieval_equals_all_pairs(spark):
    """Two and three edits, keys too long for their deletions, the limit, and documents without serials, against all pairs."""
    rng = random.Random(5)
    pool = ["USN12345678", "USN1234", "AB", "ABCDEFGHIJKLMNOPQRSTUVW", "ABCDEFGHIJKLMNOPQRST"]

    def misread(s, n):
        for _ in range(n):
            i = rng.randrange(len(s) + 1)
            s = rng.choice([s[:i] + rng.choice("0A7") + s[i:], s[:i] + s[i + 1 :], s[:i] + "9" + s[i + 1 :]])
        return s or "A"

    devs = {misread(rng.choice(pool), rng.randrange(4)): (rng.sample(["S", "T"], rng.randint(1, 2)), rng.sample(["M", "N"], 1), rng.sample(["1", "2", "3"], 2), ["7"]) for _ in range(120)}
    devs |= {f"USN77{i:02}": (["S"], ["M"], ["1"], ["7"]) for i in range(14)}
    docs = [(str(i), sorted({misread(rng.choice(pool), rng.randrange(5)) for _ in range(rng.randrange(3))}), rng.sample(["S", "T"], rng.randrange(3)), ["M"], rng.sample(["1", "2", "4"], 1), ["7"]) for i in range(150)] + [("over", ["USN7700"], ["S"], ["M"], [], [])]
    facts = [(s, x, y, p, a) for s, (xs, ys, p, a) in devs.items() for x in xs for y in ys]
    ev = spark.createDataFrame(docs, "doc_id string, serials array<string>, e_sites array<string>, e_models array<string>, e_phones array<string>, e_assets array<string>")
    got = {(r["doc_id"], r["device_key"], r["distance"], r["reason"]) for r in L.retrieve_devices(ev, spark.createDataFrame(facts, "serial string, site string, model string, phones array<string>, assets array<string>")).collect()}
    want = set()
    for doc, serials, xs, ys, ps, aa in docs:
        found = {}
        for s, (dx, dy, dp, da) in devs.items():
            placed = bool(set(xs) & set(dx) and set(ys) & set(dy))
            n = min((edits(t, s) for t in serials), default=0)
            like = max((1 - edits(t, s) / max(len(t), len(s)) for t in serials), default=1)
            if (n <= 3 and like >= 0.5 and (n <= 1 or placed)) if serials else (placed and set(ps) & set(dp) and set(aa) & set(da)):
                found[s] = n
        kept = {s: n for s, n in found.items() if n <= min(found.values()) + 1}
        if kept and len(kept) <= 10 and (serials or len(found) == 1):
            want |= {(doc, s, n, "serial_first_retrieval") for s, n in kept.items()}
        else:
            want.add((doc, None, None, "missing_serial_not_unique" if not serials else "device_candidate_limit" if len(kept) > 10 else "index_miss"))
    assert got == want and ("over", None, None, "device_candidate_limit") in got and {r[2] for r in got} >= {0, 1, 2, 3}


def test_general_engine_retrieves_no_devices_it_does_not_use(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("retrieved")

    monkeypatch.setattr(L, "retrieve_devices", refuse)
    assert devices.QUERIES["joint_date_device"](spark, DATA).count() == 108
