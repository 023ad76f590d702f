import json
import uuid

import pytest

from visitgraph.sources.index_files import DEVICE_LISTS, SITE_LISTS, VISIT_LISTS, BrokenIndex, device_violations, load_index, site_violations, write_index

VISIT = {"gid": "1", **{k: [] for k in VISIT_LISTS}}
DEVICE = {"device_key": "D1", **{k: ["x"] for k in DEVICE_LISTS}, "task_refs": [VISIT]}
SITE = {"match_enabled": True, **{k: [] for k in SITE_LISTS}}
SCHEMA = "device_key string, phones array<string>, task_refs array<struct<gid:string>>"


def test_each_broken_rule(spark):
    cases = {json.dumps(DEVICE): [], None: [("device", "", "not_an_object")], "[]": [("device", "", "not_an_object")], "{": [("device", "", "not_an_object")], json.dumps(DEVICE | {"device_key": " "}): [("device", "device_key", "missing")], json.dumps(DEVICE | {"phones": "x"}): [("device", "phones", "not_a_list")], json.dumps(DEVICE | {"task_refs": [VISIT, 5, VISIT | {"gid": None}, VISIT | {"assets": {}}]}): [("visit 1", "gid", "missing"), ("visit 2", "gid", "missing"), ("visit 3", "assets", "not_a_list")], json.dumps({"device_key": "x"}): [("device", k, "not_a_list") for k in (*DEVICE_LISTS, "task_refs")]}
    d = spark.createDataFrame(list(enumerate(cases)), "i int, body string")
    got = {i: [] for i in range(len(cases))}
    for r in device_violations(d).collect():
        got[r["i"]].append((r["place"], r["field"], r["fault"]))
    assert [sorted(x) for x in got.values()] == [sorted(x) for x in cases.values()]
    sites = spark.createDataFrame([(json.dumps(SITE),), (json.dumps(SITE | {"match_enabled": 1, "alias_sources": None}),)], "body string")
    assert sorted(map(tuple, site_violations(sites).collect())) == [("site", "alias_sources", "not_a_list"), ("site", "match_enabled", "not_a_boolean")]


def test_round_trip_and_refusal(spark, tmp_path):
    path = str(tmp_path / "index")

    def read(lines):
        at = str(tmp_path / uuid.uuid4().hex)
        lines.write.text(at)
        return spark.read.json(at)

    lines = spark.createDataFrame([(json.dumps(DEVICE | {"device_key": f"D{i}"}),) for i in range(5)], "value string")
    devices, sites = (read(x) for x in (lines, spark.createDataFrame([(json.dumps(SITE | {k: ["a"] for k in SITE_LISTS}),)], "value string")))
    manifest = write_index(devices, sites, path, {"generated_at": "2024-01-01T00:00:00Z"})
    assert manifest["device_count"] == 5 and manifest["location_count"] == 1
    assert sorted(r["device_key"] for r in load_index(spark, path, SCHEMA, "2024-01-01T00:00:00Z").collect()) == [f"D{i}" for i in range(5)]
    assert spark.read.option("header", "true").csv(f"{path}/devices-csv").count() == 5
    with pytest.raises(BrokenIndex, match="generated_at"):
        load_index(spark, path, SCHEMA, "2024-01-02T00:00:00Z")
    spark.createDataFrame([(json.dumps(DEVICE),)], "value string").write.mode("append").text(f"{path}/devices")
    with pytest.raises(BrokenIndex, match="device_count"):
        load_index(spark, path, SCHEMA)
    other = str(tmp_path / "other")
    with pytest.raises(BrokenIndex, match="sites: site confirmed_aliases"):
        write_index(devices, sites.drop("confirmed_aliases"), other, {"generated_at": "now"})
    with pytest.raises(BrokenIndex, match="no manifest"):
        load_index(spark, other, SCHEMA)
    with pytest.raises(BrokenIndex, match="no manifest"):
        load_index(spark, str(tmp_path / "none"), SCHEMA)
