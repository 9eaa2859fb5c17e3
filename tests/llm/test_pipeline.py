"""The pipeline against its stages by brute force."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from test_decontamination import brute
from test_simhash import plain_groups

import corpus_pipeline
from kontor.llm import langid
from kontor.llm.frames import learn_rows
from kontor.llm.queries import MIX_SQL, tokenizer_path
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before each stage and after the last."""
    folder = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(50_000, None, "en", "src1", 0), (50_001, "", "en", None, 0), (50_002, "12 34 !!", None, "src2", 8)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    tables = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, tables[-1], SF).write.parquet(f"{folder}/{i}")
        tables.append(spark.read.parquet(f"{folder}/{i}"))
    return [table.toPandas() for table in tables]


def test_columns_pass_through(steps):
    for table in steps[:-1]:
        assert list(table.columns) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language(spark, steps):
    model = langid.train(spark.createDataFrame(steps[0]).filter(learn_rows(F.col("doc_id"))))
    keep = [row.doc_id for row in steps[0].itertuples() if row.text and model.predict(row.text)[1] >= 0.5]
    assert sorted(keep) == sorted(steps[1].doc_id)
    assert not {50_000, 50_001, 50_002} & set(keep)


def test_copies(steps):
    groups = plain_groups(list(steps[1][["doc_id", "text"]].itertuples(index=False, name=None)))
    assert sorted({component for _, _, component in groups}) == sorted(steps[2].doc_id)


def test_benchmark(steps):
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    leaks = {key for key, _ in brute(list(steps[2][["doc_id", "text"]].itertuples(index=False, name=None)), items)}
    assert leaks and sorted(steps[3].doc_id) == sorted(set(steps[2].doc_id) - leaks)


def test_mix(steps):
    documents = steps[3]  # noqa: F841
    taken = duckdb.sql(MIX_SQL).fetchall()
    times = Counter(steps[4].doc_id)
    assert {key: times[key] * size for key, size, *_ in taken} == {key: value for key, *_, value in taken}


def test_tokens(spark, steps):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = [np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4") for text in steps[4].text]
    want = pd.DataFrame({
        "doc_id": steps[4].doc_id, "n_tokens": [len(one) for one in ids], "ids_crc32": [zlib.crc32(one.tobytes()) for one in ids],
    }).sort_values(["doc_id", "ids_crc32"])
    found = steps[5].sort_values(["start"])
    assert (found.n_tokens.cumsum() - found.n_tokens).tolist() == found.start.tolist()
    assert found.doc_id.is_monotonic_increasing
    found = found.sort_values(["doc_id", "ids_crc32"])
    for name in ("doc_id", "n_tokens", "ids_crc32"):
        assert found[name].tolist() == want[name].tolist()


def test_run_is_the_stages(spark, steps):
    assert corpus_pipeline.run(spark, SF).columns == list(steps[5].columns)
