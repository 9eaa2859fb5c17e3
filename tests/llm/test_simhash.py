"""Fingerprints, covering masks and components against brute force."""

import itertools
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from kontor.llm import simhash
from kontor.llm.components import components

SF = "/root/testdata/sf0.001"


def plain_print(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    size = min(size, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, radius=3):
    """(key, hex, smallest key reachable) by looking at all pairs."""
    prints = [plain_print(text) for _, text in rows]
    distinct = sorted(set(prints))
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= radius:
            root[find(a)] = find(b)
    least = {}
    for (key, _), f in zip(rows, prints):
        if key is not None:
            least[find(f)] = min(key, least.get(find(f), key))
    return sorted(((key, f"{f:016x}", least.get(find(f))) for (key, _), f in zip(rows, prints)), key=repr)


def found(df):
    rows = simhash.groups(df).select("key", simhash.hexadecimal(F.col("f")), "component")
    return sorted((tuple(row) for row in rows.collect()), key=repr)


def test_table_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert found(docs) == plain_groups([(row.doc_id, row.text) for row in docs.collect()])


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "two words"), (7, "Two  WORDS"), (None, "ONE"),
        (None, "alone here by itself"), (8, "a b c d"), (8, "a b c d"), (9, "É b c"), (9, "é b c"),
        (10, " ".join(f"w{i}" for i in range(30_000))), (11, "x y z"), (12, "x y z"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == plain_groups(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert found(docs) == []
    assert simhash.one_of_each(docs).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_every_choice(radius):
    places = list(range(0, 64, 3))[:14]
    kept = simhash.masks(radius, places)
    for chosen in itertools.combinations(places, radius):
        bits = sum(1 << place for place in chosen)
        assert any(not mask & bits for mask in kept)
    assert all(mask for mask in kept)


@pytest.mark.parametrize("bucket", [16, 64, 4096])
def test_crowded_buckets_lose_no_link(spark, bucket):
    chance = random.Random(5)
    centre = chance.getrandbits(64)
    near = {centre ^ sum(1 << b for b in chance.sample(range(64), chance.choice([1, 2, 3, 5, 7]))) for _ in range(400)}
    far = {chance.getrandbits(64) for _ in range(100)}
    values = sorted(near | far)
    frame = spark.createDataFrame([(value - 2**64 if value >= 2**63 else value,) for value in values], "f long")
    edges = simhash.links(frame, 3, bucket)
    pairs = [(row.a % 2**64, row.b % 2**64) for row in edges.collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    assert len(set(pairs)) < 40 * len(values)

    def classes(links):
        root = {value: value for value in values}

        def find(value):
            while root[value] != value:
                value = root[value]
            return value

        for a, b in links:
            root[find(a)] = find(b)
        return {frozenset(v for v in values if find(v) == r) for r in {find(v) for v in values}}

    everything = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 3]
    assert classes(pairs) == classes(everything)


def test_components_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(1, 40)] + [(100, x) for x in range(101, 130)] + [(200, 200), (7, 3)]
    rows = {tuple(row) for row in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert rows == {(i, 1) for i in range(1, 41)} | {(x, 100) for x in range(100, 130)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("shares", [1, 6, 512])
def test_hot_fingerprints_lose_no_row(spark, monkeypatch, shares):
    monkeypatch.setattr(simhash, "SHARES", shares)
    rows = [(i, f"text number {min(i % 20, 7)} of a few that repeat often") for i in range(60)] + [(99, None), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((row.key, row.component) for row in simhash.groups(docs).collect())
    assert found == sorted((key, component) for key, _, component in plain_groups(rows))


def test_one_of_each_keeps_one_row_and_all_columns(spark):
    text = "some words that are the same in all of these rows"
    rows = [
        (5, text, "f", 1), (3, text.upper(), "f", 2), (3, text, "f", 3), (None, text, "f", 4), (9, "other words here", "g", 5),
        (9, "other words here", "g", 5), (None, "nobody knows this one", "h", 6), (None, "nobody knows this one", "h", 7),
        (12, None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string, root long")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((row.doc_id, row.key) for row in kept.collect()), key=repr) == sorted(
        [(3, "f"), (9, "g"), (None, "h"), (12, None)], key=repr
    )


def test_one_of_each_with_keys_of_their_own(spark):
    rows = [(i, f"text number {i % 7} of a few that repeat often") for i in range(40)] + [(99, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {component for _, _, component in plain_groups(rows)}
    assert sorted(row.doc_id for row in simhash.one_of_each(docs).collect()) == sorted(want)
