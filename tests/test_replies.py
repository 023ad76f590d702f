import json

from pyspark.sql import functions as F

from visitgraph.functions.replies import chosen_option, recovered


def plainly(text, keys):
    """The same by the json module, tried at every brace."""
    text = (text or "").strip().lstrip("﻿")


    def once(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("a key twice")
        return dict(pairs)

    fits = lambda v: isinstance(v, dict) and set(keys) <= set(v)
    try:
        whole = json.loads(text, object_pairs_hook=once)
        return ("whole", whole) if fits(whole) else ("wrong_shape", None)
    except ValueError:
        pass
    for i, c in enumerate(text):
        if c == "{":
            try:
                v, _ = json.JSONDecoder(object_pairs_hook=once).raw_decode(text, i)
            except ValueError:
                continue
            if fits(v):
                return "embedded", v
    return "none", None


def test_recovery(spark):
    good = '{"a": 1, "b": {"c": "} \\" ]"}}'
    cases = [None, "", "  ", good, f"  {good}\n", f"﻿{good}", f"x {good} y", f"[{good}]", "12", "-0.5e3", "012", '"{"', '"a{\\"a\\": 1, \\"b\\": 2}"', "null", "true", good[:-1], f"{{{good}", f"{{}} {good}", f'{{"a": 1}} {good} {{"a": 2, "b": 3}}', f'say "x: {good}', f'{{"z": {good}}}', f"{{'a': 1, 'b': 2}} {good}", '{"a": 1, "b": 2,}', '{"a": "x\ny", "b": 1}', f"\\{good}", '{"a": 1, "a": 2, "b": [[], {}]}', "[1] [2]", "1, 2", '{"b": 1} {"a": 1}', "{" * 300 + good, good + "}" * 300]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, t string").select("i", recovered(F.col("t"), ("a", "b")).alias("r")).collect()
    for r in rows:
        outcome, value = plainly(cases[r["i"]], ("a", "b"))
        assert (r["r"]["outcome"], r["r"]["json"] and json.loads(r["r"]["json"])) == (outcome, value), cases[r["i"]]


def test_options(spark):
    cases = {"CM": "CM", " pm. ": "PM", "`FCO`": "FCO", "INS (marked)!": "INS", "The selected choice is CM": "CM", "circled word PM.": "PM", "WORD CM IS CIRCLED": "CM", "cm is the\n marked option": "CM", "": "UNKNOWN", None: "UNKNOWN", "CM PM": "UNKNOWN", "not CM": "UNKNOWN", "PM?": "UNKNOWN", "CM (maybe)": "UNKNOWN", "the CM": "UNKNOWN"}
    d = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r["t"]: r["o"] for r in d.select("t", chosen_option(F.col("t")).alias("o")).collect()} == cases
    assert d.select(chosen_option(F.lit("?"), F.lit("pm")).alias("o")).first()["o"] == "PM"
