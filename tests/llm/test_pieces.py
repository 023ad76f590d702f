"""Pieces against the library: ids, places in the text, decoding."""

import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitgraph.llm.pieces import Normalizer, PieceEncoder, decode_pieces, encode_pieces, model_path, op13_pieces

TEXTS = ["", " ", "   ", "a", " a", "a ", "a  b", "Hello  world \n\n x\ty", "\n", "\n\na", "▁", "a▁b ▁ c", "éÈ ß 漢字 😀😀 ①ﬁ", "<s> </s> <0x41> <unk>", "\x00a\x00 b", "word." * 300, "x" * 5000, "... \"q\" (a);\r\n b", "é  　 z", "ᄀ ﷺ​﻿"]


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(model_path(), room=50)


def same(encoder, text):
    ids, starts, ends = encoder.encode(text)
    want = encoder.whole.encode(text, return_type="proto")
    assert ids.tolist() == [p.id for p in want.pieces]
    raw = text.encode()
    assert [raw[a:z].decode() for a, z in zip(starts, ends, strict=True)] == [p.surface for p in want.pieces]
    assert b"".join(raw[a:z] for a, z in zip(starts, ends, strict=True)) == raw


@pytest.mark.parametrize("text", TEXTS)
def test_texts(encoder, text):
    same(encoder, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab .\n▁é漢", max_size=60))
def test_any_text(encoder, text):
    same(encoder, text)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
def test_character_maps(rule, squeeze, prefix):
    """The library's own compiled maps: the same text, and the same source of every code point."""
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=prefix, escape_whitespaces=True, remove_extra_whitespaces=squeeze)
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto.FromString(theirs.serialized_model_proto()).normalizer_spec
    ours = Normalizer(spec.precompiled_charsmap, prefix, squeeze, True)
    for text in TEXTS:
        want, offsets = theirs.Normalize(text, with_offsets=True)
        got, source = ours.normalize(text)
        assert got.decode() == want
        lead = [i for i, b in enumerate(got) if b & 0xC0 != 0x80]
        points = [len(text.encode()[: source[i]].decode()) for i in [*lead, len(got)]]
        assert points == list(offsets)


def test_query(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "a b"), (3, "a"), (99, None)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    d.selectExpr("doc_id", "text", "1 AS ids", "2 AS name").write.parquet(f"{tmp_path}/documents.parquet")
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = [(i, len(ids := sp.encode(t or "")), sha(",".join(map(str, ids))), sha(sp.decode(ids)), len((t or "").encode())) for i, t in rows]
    stored = encode_pieces(d, model_path()).withColumn("back", decode_pieces(F.col("ids"), model_path()))
    assert sorted(r["back"] for r in stored.collect()) == sorted(sp.decode(sp.encode(t or "")) for _, t in rows)
    assert sorted(map(tuple, op13_pieces(spark, str(tmp_path)).collect()), key=repr) == sorted(want, key=repr)


def test_no_rows(spark):
    out = encode_pieces(spark.createDataFrame([], "ids string, text string"), model_path(), id_col="ids")
    assert out.columns[1:] == ["ids", "starts", "ends"] and not out.collect()


def test_new_words_of_many_texts_are_learnt_at_once():
    """One call of the library for all texts handed over, and the same pieces as one by one, also past the room."""
    e, calls = PieceEncoder(model_path(), room=50), []
    learn = e.learn
    e.learn = lambda words: (calls.append(len(words)), learn(words))
    texts = [*TEXTS, None, *[f"w{i} x{i % 7}\ny{i}" for i in range(60)]]
    alone = PieceEncoder(model_path(), room=50)
    for got, text in zip(e.encode_all(texts), texts, strict=True):
        assert [x.tolist() for x in got] == [x.tolist() for x in alone.encode(text)]
    assert len(calls) == 1
    assert e.decode_all([x[0] for x in e.encode_all(texts)]) == [e.decode(alone.encode(t)[0]) for t in texts]
