"""Evidence of a document is made in its own row, and no more pairs of documents and devices are moved than can be kept."""

from pyspark.sql import functions as F

from tests.conftest import DATA
from visitgraph.operators import decisions as D
from visitgraph.operators import gathered as G
from visitgraph.operators import linkage as L
from visitgraph.operators.evidence import crosspage_conflicts, keyed
from visitgraph.operators.tables import settled, spent
from visitgraph.sources.fixtures import first_orders, gathered_rows, given, readings


def plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def rows(d):
    return sorted(map(repr, d.collect()))


def test_evidence_is_made_in_rows(spark):
    r = settled(readings(spark, DATA))
    keys = settled(keyed(r))
    orders = settled(first_orders(given(spark, DATA)))
    labels = G.labels_of(gathered_rows(orders))
    evidence = G.evidence_of(G.keyed_rows(gathered_rows(orders), labels))
    assert "Exchange hashpartitioning" not in plan(evidence) and "SortMergeJoin" not in plan(evidence)
    want = rows(D.evidence_row(r, keys))
    assert rows(evidence.drop("mixed")) == want and rows(G.evidence_of(G.gathered(r, keys)).drop("mixed")) == want
    two = lambda d: d.where("round <= 2")
    assert rows(G.evidence_of(G.upto(G.gathered(r, keys), 2)).drop("mixed")) == rows(D.evidence_row(two(r), two(keys)))
    spent(r, keys, orders, labels)


def test_pages_of_their_own_are_mixed(spark):
    read = [("a", 1, 0, "S"), ("a", 2, 0, "S"), ("a", 3, 1, "T"), ("a", 4, 1, "T"), ("b", 1, 0, "S"), ("b", 2, 0, "S"), ("b", 3, 1, "S"), ("b", 4, 1, "S"), ("c", 1, 0, "S"), ("c", 2, 0, "S"), ("c", 3, 1, "T"), ("d", 1, 0, "T"), ("d", 2, 0, "T"), ("d", 3, 1, "T"), ("d", 4, 1, "T"), ("d", 5, 1, "S"), ("d", 6, 1, "S")]
    keys = spark.createDataFrame([(*x[:3], "", "hospital_raw", x[3], x[3]) for x in read], "doc_id string, round int, page int, source string, field string, raw string, key string")
    got = G.evidence_of(G.gathered(keys.select("doc_id", F.lit(None).cast("date").alias("reference_day")), keys))
    assert {r["doc_id"]: r["mixed"] for r in got.collect()} == {"a": True, "b": False, "c": False, "d": False}
    assert {r["doc_id"] for r in crosspage_conflicts(keys).where("conflict").collect()} == {"a"}


def test_texts_agree_on_one_key(spark):
    d = spark.createDataFrame([(["x", "X ", None, "y"], ["X", "X", "", "Y"]), (["x", "x", "y", "y"], ["X", "X", "Y", "Y"]), (["x", None, "y", None], ["X", "", "Y", ""])], "t array<string>, k array<string>")
    assert [r[0] for r in d.select(G.agreed(F.col("t"), F.col("k"))).collect()] == ["x", None, None]


def test_serials_near_many_devices_bring_no_pair(spark):
    """A document over the limit is told from its serial alone; one device less, and all of them come."""
    facts = spark.createDataFrame([(f"USN7700{i}", "S", "M", ["1"], ["7"]) for i in range(8)] + [(f"USN8800{i}", "S", "M", ["1"], ["7"]) for i in range(3)], "serial string, site string, model string, phones array<string>, assets array<string>")
    ev = spark.createDataFrame([("over", ["USN77000"]), ("some", ["USN88000", "USN8800"]), ("both", ["USN88001", "USN77007"]), ("none", ["ABC"])], "doc_id string, serials array<string>")
    ev = ev.selectExpr("*", "array('S') AS e_sites", "array('M') AS e_models", "array('1') AS e_phones", "array('7') AS e_assets")
    dev = settled(L.device_table(facts))
    got = {r["doc_id"]: (r["over"], [tuple(x) for x in r["found"]], r["closest"]) for r in L._one_edit(ev, dev, 7).collect()}
    near = [("USN88000", 0), ("USN88001", 1), ("USN88002", 1)]
    assert got == {"over": (True, [], None), "some": (False, near, 0), "both": (True, [], None), "none": (False, [], None)}
    assert {r["doc_id"]: len(r["found"]) for r in L._one_edit(ev, dev, 8).collect()} == {"over": 8, "some": 3, "both": 0, "none": 0}
    spent(dev)


def test_records_that_say_alike_are_judged_once(spark):
    facts = spark.createDataFrame([(str(i), "USN1", "S", "M", "M", ["1"], ["7"], ["c"], "PM", None, None) for i in range(3)] + [(str(i + 3), "USN2", "S", "M", "M", ["1"], ["7"], ["c"], "PM", None, None) for i in range(5)], "gid string, serial string, site string, model string, model_name string, phones array<string>, assets array<string>, contacts array<string>, job_type string, due date, order_no string")
    pool = spark.createDataFrame([("a", False, ["USN1"]), ("b", True, ["USN2"])], "doc_id string, over boolean, pool array<string>")
    got = D.profiles(pool, facts, most=4).collect()
    assert [(r["doc_id"], sorted(x["gid"] for x in r["visits"])) for r in got] == [("a", ["0", "1", "2"])]
