"""What a task sorts or keeps doesn't grow with the tables, nor is a row's work done twice."""

from tests.conftest import DATA
from visitgraph.operators import evidence as E
from visitgraph.operators import tables
from visitgraph.operators.index import first_wins
from visitgraph.operators.tables import settled
from visitgraph.sources.fixtures import readings, work_records


def plan(d):
    return d._jdf.queryExecution().executedPlan().toString()


def test_parts_follow_rows(spark, monkeypatch):
    whole = sorted(map(repr, work_records(spark, DATA, first=True).collect()))
    monkeypatch.setattr(tables, "TASK_ROWS", 500)
    n = -(-spark.read.parquet(f"{DATA}/lineitem.parquet").count() // 500)
    d = work_records(spark, DATA, first=True)
    assert f", {n}), REPARTITION_BY_NUM" in plan(d) and "Window" not in plan(d)
    assert sorted(map(repr, d.collect())) == whole
    r = settled(readings(spark, DATA))
    assert "hashpartitioning(doc_id" in plan(E.keyed(r)) and f", {-(-r.count() // 500)}), REPARTITION_BY_NUM" in plan(E.keyed(r))


def test_one_row_of_each_order(spark, tmp_path):
    """Orders and lines that come twice still give one row of each order, the one that wins among all."""
    for t in ("orders", "lineitem"):
        d = spark.read.parquet(f"{DATA}/{t}.parquet")
        d.union(d).write.parquet(f"{tmp_path}/{t}.parquet")
    for t in ("customer", "nation"):
        spark.read.parquet(f"{DATA}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    every, first = work_records(spark, str(tmp_path)), work_records(spark, str(tmp_path), first=True)
    assert sorted(map(repr, first_wins(every).collect())) == sorted(map(repr, first.collect()))


def test_device_rows_are_judged_by_casts(spark):
    """Odd rows of an index; no schema of a whole value is worked out to tell what kind it is, nor a list's size asked for first."""
    from visitgraph.sources.index_files import DEVICE_LISTS, VISIT_LISTS, device_violations

    lists = ", ".join(f'"{k}": []' for k in DEVICE_LISTS)
    visit = ", ".join(f'"{k}": [{{}}]' for k in VISIT_LISTS)
    bodies = [None, "", "null", "[]", "{}", '"x"', f'{{"device_key": "a", {lists}, "task_refs": [null, 1, [], {{"gid": " ", {visit}}}, {{"gid": "g", {visit}}}]}}', f'{{"device_key": 7, {lists.replace("[]", "{}", 1)}, "task_refs": null}}']
    d = device_violations(spark.createDataFrame(list(enumerate(bodies)), "i int, body string"))
    at = lambda i: [(r["place"], r["field"], r["fault"]) for r in d.where(f"i = {i}").collect()]
    for i in (0, 1, 2, 3, 5):
        assert at(i) == [("device", "", "not_an_object")]
    assert at(4) == [("device", "device_key", "missing"), *[("device", k, "not_a_list") for k in (*DEVICE_LISTS, "task_refs")]]
    assert at(6) == [(f"visit {n}", "gid", "missing") for n in range(4)]
    assert at(7) == [("device", DEVICE_LISTS[0], "not_a_list"), ("device", "task_refs", "not_a_list")]
    assert "schemaOfVariant" not in plan(d)


def test_readings_are_judged_once_and_stay(spark):
    """Few labels travel to the readings, and no list of faults is worked out for its size first."""
    from visitgraph.plans.review import rejection_stats

    p = plan(rejection_stats(spark, DATA))
    assert "SortMergeJoin" not in p and p.count("BroadcastHashJoin") == 3
    assert not [line for line in p.splitlines() if "Filter (" in line and "size(" in line]
