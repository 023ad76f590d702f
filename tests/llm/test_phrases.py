"""Phrases against plain counting by SQL; filters against sorted pairs."""

from collections import Counter

import duckdb
import numpy as np
import pytest

from visitgraph.llm import phrases
from visitgraph.llm.phrases import OP12, mine_phrases


@pytest.mark.parametrize("width", [1, 7, 18, 32, 33, 40, 64])
def test_filters_lose_nothing(width):
    rng = np.random.default_rng(width)
    top = (1 << width) - 1
    hi, lo = (rng.integers(0, min(top, 50) + 1, 3000).astype(np.uint64) * np.uint64(max(1, top // 50)) for _ in range(2))
    q, r = phrases.permuted(hi, lo, width)
    back = phrases.permuted(q, r, width, back=True)
    assert (back[0] == hi).all() and (back[1] == lo).all()
    want = sorted(Counter(zip(q.tolist(), r.tolist(), strict=True)).items())
    parts = [phrases.frozen(*phrases.tallied(q[a : a + 700], r[a : a + 700], width)) for a in range(0, 3000, 700)]
    got = phrases.merged(parts, width)
    assert [((a, b), c) for a, b, c in zip(*(x.tolist() for x in got), strict=True)] == want


def compare(spark, rows, least, **options):
    docs = spark.createDataFrame(rows, "text string, lang string").selectExpr("text", "lang", "1 AS word", "2 AS n", "3 AS shard").repartition(3)
    got = sorted(map(tuple, mine_phrases(docs, least=least, **options).collect()), key=repr)
    c = duckdb.connect()
    c.register("documents", docs.select("text", "lang").toPandas())
    want = sorted(c.execute(OP12.replace(">= 30", f">= {least}")).fetchall(), key=repr)
    assert got == want
    return got


@pytest.mark.parametrize("options", [{}, {"shard_tokens": 40, "mark_bits": 3}])
def test_odd_texts(spark, options):
    rng = np.random.default_rng(4)
    words = ["a", "b", "The", "the", "é", "ÉCOLE", "\x1fx", "\x00", "x-y", "1", "—"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", "!?"]
    rows = []
    for i in range(120):
        n = int(rng.integers(0, 40))
        rows.append(("".join(words[a] + gaps[b] for a, b in zip(rng.integers(0, 11, n), rng.integers(0, 11, n), strict=True)), [None, "en", "de", "und", ""][i % 5]))
    rows += [(None, "en"), ("", None), (" \t.", "en"), ("a b a b " * 4000, "fr"), ("new york city hall " * 9, "es")] + [("copy of one text here. and more", "en")] * 200
    assert len(compare(spark, rows, 3, **options)) > 100


def test_no_rows(spark):
    assert not compare(spark, [], 2)
    assert not compare(spark, [(None, None), ("one", "en")], 2)
