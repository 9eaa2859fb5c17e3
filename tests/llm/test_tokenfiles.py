"""Token files: exact round trip, order, keyed access and the perfect hash."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from kontor.llm import chunktable, mph, tokenfiles
from kontor.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
ODD = [
    (1, "a  b   c"), (2, None), (3, ""), (None, " x"), (None, "y \n z"), (4, "it's don't 'tis   x y \x1cq can't."),
    (5, "a <|endoftext|> b<|endoftext|>. c"), (5, "dup"), (5, "dup"), (6, "tab\t tab \t x\n\n\ny 日本 語 12 3,4 "), (7, " "),
    (8, "   lead"), (9, "ends.  with!! ''s ÀÉ** x** été, 　été ... #1 a_b |"), (-3, "The 'The.' the' the'."),
    (2**40, "wide " * 40_000),
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def expected(rows, tokenizer):
    ids = [(key, tokenizer.encode(text or "", add_special_tokens=False).ids + [0]) for key, text in rows]
    return sorted(((key, len(one), zlib.crc32(np.array(one, "<u4").tobytes())) for key, one in ids), key=repr)


def read(spark, frame):
    files = tokenfiles.write_tokens(frame, tokenizer_path())
    return files, [tuple(row) for row in tokenfiles.read_back(spark, files).collect()]


def test_round_trip(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    for rows in ([tuple(row) for row in docs], ODD, []):
        frame = spark.createDataFrame([(*row, 1, "k") for row in rows], "doc_id long, text string, start int, key string")
        files, found = read(spark, frame)
        assert sorted(((key, n, crc) for key, _, n, crc in found), key=repr) == expected(rows, tokenizer)
        found.sort(key=lambda row: row[1])
        assert [row[1] for row in found] == [sum(row[2] for row in found[:i]) for i in range(len(found))]
        keys = [row[0] for row in found]
        assert keys == sorted(keys, key=lambda key: (key is not None, key or 0))


def test_keyed_access(spark, tokenizer):
    frame = spark.createDataFrame(ODD, "doc_id long, text string")
    files = tokenfiles.write_tokens(frame, tokenizer_path())
    wanted = spark.createDataFrame([(1,), (5,), (77,), (None,), (2**40,), (1,)], "doc_id long")
    rows = sorted((row.key, row.ids) for row in tokenfiles.lookup(files, wanted).collect())
    assert rows == sorted(
        (key, tokenizer.encode(text, add_special_tokens=False).ids + [0]) for key, text in ODD if key in (1, 5, 2**40)
    )


def plain(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_a_full_table_does_not_change_ids(monkeypatch, tokenizer):
    monkeypatch.setattr(chunktable, "MOST_CHUNKS", 3)
    monkeypatch.setattr(tokenfiles, "PIECES_AT_ONCE", 5)
    encoder = tokenfiles.PieceEncoder(tokenizer_path())
    texts = [text or "" for _, text in ODD]
    for _ in range(2):
        for some in (texts, *([text] for text in texts)):
            assert [ids.tolist() for ids in encoder.encoded(pa.array(some))] == [plain(tokenizer, text) for text in some]
    assert list(encoder.encoded(pa.array([], pa.string()))) == []
    sliced = pa.array(["skipped", *texts, "too"]).slice(1, len(texts))
    assert [ids.tolist() for ids in encoder.encoded(sliced)] == [plain(tokenizer, text) for text in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(
    "ab é\u00e9Z.,'s\n\t\r\x0b\x1c\x85\xa0\u1680\u2003\u2009\u200b\u2028\u202f\u205f\u3000日ñ1_-\U0001f600«”"), max_size=25), max_size=5))
def test_any_text(tokenizer, texts):
    found = tokenfiles.PieceEncoder(tokenizer_path()) if not ENCODERS else ENCODERS[0]
    ENCODERS[:] = [found]
    assert [ids.tolist() for ids in found.encoded(pa.array(texts, pa.string()))] == [plain(tokenizer, text) for text in texts]


ENCODERS: list = []


def test_texts_of_other_tokenizers_are_not_cut():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    whole, texts = Tokenizer.from_file(path), ["Two words, and\nlines", "", "  It's 3 "]
    assert [ids.tolist() for ids in tokenfiles.PieceEncoder(path).encoded(pa.array(texts))] == [plain(whole, text) for text in texts]


def test_portions_hold_all_texts(monkeypatch):
    monkeypatch.setattr(tokenfiles, "BYTES_AT_ONCE", 5)
    texts = pa.array(["ab", "", "abcdefgh", "abc", "de", "f", ""])
    assert [part.to_pylist() for part in tokenfiles._portions(texts)] == [["ab", ""], ["abcdefgh"], ["abc", "de"], ["f", ""]]


@pytest.mark.parametrize("size", [0, 1, 2, 63, 64, 65, 20_000])
def test_perfect_hash_is_minimal(size):
    numbers = np.random.default_rng(size).integers(0, 2**64, size, dtype=np.uint64)
    table = mph.build(numbers)
    assert sorted(mph.places(table, numbers)) == list(range(size))
    strangers = np.random.default_rng(size + 1).integers(0, 2**64, 1000, dtype=np.uint64)
    assert (mph.places(table, strangers) < max(1, size)).all()


def test_keys_with_equal_hashes_stay_apart(monkeypatch, tmp_path):
    import pyarrow as pa

    monkeypatch.setattr(tokenfiles, "key_numbers", lambda keys: np.array([len(str(key)) for key in keys], np.uint64))
    keys = ["a", "b", "b", "cc", "ddd", "eee"]
    offsets = np.arange(6)
    table = pa.table({"key": keys, "offset": offsets, "n_ids": np.ones(6, np.int64)})
    (tmp_path / "s.mph").write_bytes(tokenfiles.index_bytes(keys))
    with pa.ipc.new_file(str(tmp_path / "s.keys"), table.schema) as writer:
        writer.write_table(table)
    shard = tokenfiles.Shard(tmp_path.as_uri(), "s", "<u2")
    first, count = shard.find(["a", "b", "cc", "ddd", "eee", "zz"])
    assert list(zip(first, count))[:5] == [(0, 1), (1, 2), (3, 1), (4, 1), (5, 1)]
