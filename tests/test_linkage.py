import numpy as np
from pyspark.sql import functions as F

from tests.conftest import DATA
from visitgraph.operators import devices as V
from visitgraph.operators import linkage as L
from visitgraph.operators import search as S
from visitgraph.operators.evidence import keyed
from visitgraph.operators.stages import ACCEPTED, staged_match
from visitgraph.operators.tables import settled, spent
from visitgraph.sources.fixtures import readings, work_records


def test_stages_work_on_fewer_documents(spark):
    r = settled(readings(spark, DATA).where("CAST(doc_id AS BIGINT) % 4 = 1"))
    silent = r.limit(1).select([F.lit("silent").alias("doc_id") if c == "doc_id" else F.col(c) if c in ("round", "page", "source", "reference_day") else F.lit(None).cast(t).alias(c) for c, t in r.dtypes])
    r = settled(r.unionByName(silent))
    parsed = L.parsed_records(work_records(spark, DATA))
    types = parsed.select(F.col("gid").alias("doc_id"), F.col("job_type").alias("doc_type"))
    out, sizes = staged_match(r, settled(keyed(r)), settled(L.record_facts(parsed)), types)
    rows = out.collect()
    assert sizes[0] > sizes[1] > sizes[2] > 0 and sizes[0] == len(rows) - 1
    assert [(x["reason"], x["stage"], x["gid"]) for x in rows if x["doc_id"] == "silent"] == [("no_usable_reading", 0, None)]
    for n in (1, 2):
        assert sizes[n - 1] - sizes[n] == sum(x["stage"] == n and x["reason"] in ACCEPTED for x in rows)
    assert all(len(x["trace"].split(";")) == x["stage"] for x in rows if x["stage"])


def test_containment_equals_a_full_scan(spark):
    rng = np.random.default_rng(8)
    bodies = ["".join(rng.choice(list("AB12"), rng.integers(0, 40))) for _ in range(200)]
    terms = {"".join(rng.choice(list("AB12"), rng.integers(1, 12))) for _ in range(150)} | {"", "AB", "ZZZ", bodies[0]}
    b = spark.createDataFrame([(str(i), t) for i, t in enumerate(bodies)], "gid string, body string")
    got = {(r["term"], r["gid"]) for r in S.containing(spark.createDataFrame([(t,) for t in terms] * 2, "term string"), b).collect()}
    assert got == {(t, str(i)) for t in terms if len(t) >= 3 for i, x in enumerate(bodies) if t in x}


def test_pool_keeps_documents_and_tells_full_terms(spark):
    records = spark.createDataFrame([(str(i), f"QMH / X{i}", "") for i in range(5)] + [("9", "PWH / X1", "SERIAL12")], "gid string, name string, notes string")
    none = "CAST(array() AS array<string>)"
    evidence = spark.createDataFrame([("a", ["QMH"], ["X3"], ["SERIAL12"]), ("b", ["ABC"], [], []), ("c", [], [], [])], "doc_id string, sites array<string>, models array<string>, serials array<string>").selectExpr("*", f"{none} AS orders", f"{none} AS phones", f"{none} AS assets")
    rows = sorted((r["doc_id"], r["gid"] or "", r["hits"], r["overfull"]) for r in S.text_search_pool(evidence, records, page=5).collect())
    assert rows == [("a", "3", 3, "QMH"), ("a", "9", 1, "QMH"), ("b", "", None, ""), ("c", "", None, "")]


def test_devices_by_hand(spark):
    facts = spark.createDataFrame([("1", "USN1234567", "QMH", "EPIQ", ["21112222"], ["12345678"], ["anne"], "PM", "2024-03-02"), ("2", "USN1234568", "QMH", "EPIQ", ["23334444"], ["99999999"], ["bert"], "PM", "2024-06-01"), ("3", "USN7777777", "PWH", "CX", ["25556666"], ["11112222"], ["carl"], "CM", "2024-03-01")], "gid string, serial string, site string, model string, phones array<string>, assets array<string>, contacts array<string>, job_type string, due string").withColumn("due", F.to_date("due")).withColumn("order_no", F.lit(None).cast("string"))
    columns = "doc_id string, doc_type string, w_sites array<string>, w_models array<string>, w_serials array<string>, w_phones array<string>, w_assets array<string>, w_contacts array<string>, day string"
    ask = spark.createDataFrame([
        ("equal", "PM", ["QMH"], ["EPIQ"], ["USN1234567"], [], [], [], None),  # its neighbour is as near as 0.1
        ("fixed", "PM", ["QMH"], ["EPIQ"], ["USN1234560"], ["21112222"], [], [], "2024-03-03"),  # one edit from both, one visit agrees
        ("bare", "CM", ["PWH"], ["CX"], [], ["25556666"], ["11112222"], [], None),
        ("unplaced", "PM", [], ["EPIQ"], ["USN1234567"], ["21112222"], [], [], None),
        ("far", "PM", ["QMH"], ["EPIQ"], ["ZZ99"], [], [], [], None),
        ("strange", "PM", ["XYZ"], ["MX"], ["USN1234567"], [], [], [], None),
    ], columns).withColumn("day", F.to_date("day"))
    devices = settled(V.device_rows(facts))
    ranked, joint = V.scored_devices(ask, devices), settled(V.joint_date_devices(ask, facts))
    got = {(r["doc_id"], r["device_key"], r["place"], r["reason"]) for r in ranked.collect()}
    assert got == {("equal", "USN1234567", 1, "ranked"), ("equal", "USN1234568", 2, "ranked"), ("fixed", "USN1234567", 1, "ranked"), ("fixed", "USN1234568", 2, "ranked"), ("bare", "USN7777777", 1, "ranked"), ("unplaced", "USN1234567", 1, "ranked"), ("far", None, None, "no_device_near"), ("strange", None, None, "index_miss")}
    assert [(r["doc_id"], r["device_key"], r["reason"]) for r in joint.collect()] == [("fixed", "USN1234567", "joint_date_corrected")]
    close = {(r["doc_id"], r["candidate"], r["device_key"]) for r in V.close_candidates(ranked, joint, ask).collect()}
    assert close == {(d, c, k) for d in ("equal", "fixed") for c, k in (("C1", "USN1234567"), ("C2", "USN1234568"))}
    pool = {r["doc_id"]: (r["gid"], r["reason"]) for r in V.record_pool(ranked, joint, ask, facts).collect()}
    assert pool == {"equal": (None, "close_candidates"), "fixed": ("1", "joint_date_corrected"), "bare": ("3", "device_accepted"), "unplaced": ("1", "device_accepted"), "far": (None, "no_device_near"), "strange": (None, "index_miss")}
    spent(ranked, joint, devices)
