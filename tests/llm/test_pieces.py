"""Ids and texts against the library on whole texts."""

import hashlib

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontor.llm import chunktable, pieces
from kontor.llm.queries import QUERIES

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PLAIN = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXTS = [
    "", " ", "  ", "a", " a", "a ", "a  ", "  a  b   c ", "▁a▁▁ b", "a\x00b", "a\n  b\tc", "<s>x</s> <unk> <0x0A>",
    "ﬁ Ａ　b", "\U0001f600 \U0001f600", "中文" * 500, "word " * 3000, " " * 70 + "deep", "é é", "x" * 5000,
]


def plain(text):
    return PLAIN.encode(text or "")


def ours(texts):
    return [ids.tolist() for ids in pieces.Pieces(MODEL).encoded(texts)]


def test_texts():
    assert ours(TEXTS) == [plain(text) for text in TEXTS]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab ▁\né中\x00.,1<s>\U0001f600"), max_size=30), max_size=6))
def test_any_text(texts):
    assert ours(texts) == [plain(text) for text in texts]


def test_long_texts_are_cut_between_chunks(monkeypatch):
    monkeypatch.setattr(pieces, "AT_ONCE", 7)
    assert ours(TEXTS) == [plain(text) for text in TEXTS]


def test_a_full_table_starts_anew(monkeypatch):
    monkeypatch.setattr(chunktable, "MOST_CHUNKS", 3)
    known = pieces.Pieces(MODEL)
    for _ in range(2):
        for text in TEXTS:
            assert [ids.tolist() for ids in known.encoded([text])] == [plain(text)]


def test_a_chunk_is_segmented_once(monkeypatch):
    known = pieces.Pieces(MODEL)
    asked = []
    segment = known.table.segment
    monkeypatch.setattr(known.table, "segment", lambda new: asked.extend(new) or segment(new))
    list(known.encoded(["one two one", "two  two"]))
    list(known.encoded(["one three"]))
    assert sorted(asked) == [" two", "one", "three", "two"]


def test_models_with_another_rule_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.pieces[500].piece = "a▁b"
    (tmp_path / "crossing.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        pieces.require_chunks(str(tmp_path / "crossing.model"))


def test_table(spark):
    rows = [(i, text, "s") for i, text in enumerate(TEXTS)] + [(None, "a b", "s"), (3, None, None), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = pieces.encode(df, MODEL).withColumn("text", pieces.decoded(F.col("ids"), MODEL)).collect()
    expected = [(key, plain(text), PLAIN.decode(plain(text))) for key, text, _ in rows]
    assert sorted(map(repr, expected)) == sorted(repr((row.key, row.ids, row.text)) for row in found)
    assert pieces.encode(df.limit(0), MODEL).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    found = {tuple(row) for row in QUERIES["op11_sentencepiece"](spark, sf).collect()}
    expected = set()
    for row in spark.read.parquet(f"{sf}/documents.parquet").collect():
        ids = plain(row.text)
        digests = (",".join(map(str, ids)), PLAIN.decode(ids))
        expected.add((row.doc_id, len(ids), *(hashlib.sha256(one.encode()).hexdigest() for one in digests)))
    assert found == expected
