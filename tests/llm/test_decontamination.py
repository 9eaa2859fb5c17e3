"""Leaks against all shared shingles by brute force, and odd rows."""

import random
import re
from collections import Counter

from kontor.llm import decontamination
from oracle import connect, differences

from __spark_entry__ import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def cut(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)]


def brute(docs, items, threshold=0.8):
    """(key, item ids) by trying every alignment of every shared shingle."""
    result = []
    for key, text in docs:
        ours, hit = cut(text), set()
        for item_id, item in items:
            theirs = cut(item)
            for at in {p - q for p, x in enumerate(ours) for q, y in enumerate(theirs) if x == y}:
                window = Counter(ours[max(0, at):at + len(theirs)])
                common = (window & Counter(theirs)).total()
                if common / (window.total() + len(theirs) - common) >= threshold:
                    hit.add(item_id)
        if hit:
            result.append((key, sorted(hit)))
    return sorted(result, key=repr)


def found(spark, docs, items):
    frame = spark.createDataFrame([(*row, 1, "x") for row in docs], "doc_id long, text string, n int, text_key string")
    bench = spark.createDataFrame([(*row, 2) for row in items], "item_id long, text string, m int")
    return frame, bench, sorted(((r.key, list(r.item_ids)) for r in decontamination.leaks(frame, bench).collect()), key=repr)


def test_near_copies(spark):
    chance = random.Random(2)
    words = [f"w{i}" for i in range(4_000)]
    items = [(i, " ".join(chance.choices(words, k=chance.choice([4, 5, 9, 40, 80, 120])))) for i in range(30)]
    docs = []
    for k in range(60):
        body = chance.choices(words, k=150)
        passage = chance.choice(items)[1].split()
        for _ in range(k % 3):
            place = chance.randrange(len(passage))
            passage[place:place + 1] = chance.choice([[], ["new"], [passage[place], "more"]])
        at = chance.randrange(150)
        docs.append((k, " ".join(body[:at] + [w.upper() if k % 2 else w + "," for w in passage] + body[at:])))
    frame, bench, rows = found(spark, docs, items)
    assert rows == brute(docs, items)
    kept = sorted(row.doc_id for row in decontamination.clean(frame, bench).collect())
    assert kept == sorted({key for key, _ in docs} - {key for key, _ in rows})


def test_borderline_pairs(spark):
    """Items with their last words changed, down to the least similarity that counts, within a text and at its start."""
    chance = random.Random(5)
    fresh = iter(f"v{i}" for i in range(1_000_000))
    docs, items = [], []
    for k in range(600):
        m = chance.choice([9, 14, 18, 27, 45, 53])
        item = [next(fresh) for _ in range(m + 4)]
        same = next(c for c in range(m + 1) if c / (2 * m - c) >= 0.8)
        around = [next(fresh) for _ in range(20)] if k % 2 else []
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(around + item[:same + 4] + [next(fresh) for _ in range(m - same)] + around)))
    _, _, rows = found(spark, docs, items)
    assert sorted(rows) == [(k, [k]) for k in range(600)]


def every_start(docs, items, threshold=0.8):
    """{(key, item id): greatest similarity} by trying each window of an item's size, clipped at the text's edges."""
    result = {}
    for key, text in docs:
        ours = cut(text)
        for item_id, item in items:
            theirs = Counter(cut(item))
            m = theirs.total()
            for at in range(1 - m, len(ours)) if set(ours) & set(theirs) else ():
                window = Counter(ours[max(0, at):at + m])
                common = (window & theirs).total()
                similarity = common / (window.total() + m - common)
                if similarity >= threshold:
                    result[key, item_id] = max(similarity, result.get((key, item_id), 0))
    return result


def test_windows_at_every_start(spark):
    fresh = iter(f"v{i}" for i in range(1_000_000))
    docs, items = [], []
    for k, (size, off, new) in enumerate([(58, 1, 2), (66, 1, 2), (80, 2, 4)]):  # ends left out, new words in the middle
        item = [next(fresh) for _ in range(size)]
        body = item[off:-off]
        middle = len(body) // 2
        around = [next(fresh) for _ in range(100)]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join(around + body[:middle] + [next(fresh) for _ in range(new)] + body[middle:] + around)))
    swapped = [next(fresh) for _ in range(64)]
    around = [next(fresh) for _ in range(100)]
    items.append((3, " ".join(swapped)))
    docs.append((3, " ".join(around + swapped[32:] + swapped[:32] + around)))  # aligned starts lie more than m apart
    chance = random.Random(9)
    few = [f"r{i}" for i in range(3)]
    for k in range(4, 14):  # repeated shingles, and windows clipped at either edge
        item = chance.choices(few[:2], k=30) if k % 2 else [next(fresh) for _ in range(30)]
        items.append((k, " ".join(item)))
        docs.append((k, " ".join([item[3:] + around, around + item[:-3], item[2:-1], item + item, item[1:-1]][k % 5])))
    want = every_start(docs, items)
    assert {(0, 0), (1, 1), (2, 2), (3, 3)} <= set(want)
    _, _, rows = found(spark, docs, items)
    assert rows == sorted(((key, sorted(i for one, i in want if one == key)) for key in {key for key, _ in want}), key=repr)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    best = {row.key: row.similarity for row in decontamination.leaks(frame, bench).collect()}
    assert best == {key: max(value for (one, _), value in want.items() if one == key) for key in best}


def test_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten"
    items = [(1, passage), (1, passage), (2, passage), (None, "alpha beta gamma delta epsilon zeta eta theta"), (3, None), (4, ""),
             (5, "too short here"), (6, "r r r r r r r r r r r r")]
    docs = [
        (1, passage), (1, passage), (None, passage.upper()), (2, None), (3, ""), (4, "clean text with words enough to be cut into shingles"),
        (5, "x " * 200_000 + passage), (6, "alpha, beta! gamma delta (epsilon) zeta eta theta"), (7, "too short here"),
        (8, passage + " " + passage), (9, "r " * 50), (10, "five six seven eight nine ten"),
    ]
    frame, bench, rows = found(spark, docs, items)
    assert [row for row in rows if row[0] not in (6,)] == sorted(
        [(1, [1, 2]), (1, [1, 2]), (None, [1, 2]), (5, [1, 2]), (8, [1, 2]), (9, [6])], key=repr
    )
    assert (6, []) in rows  # a null item id is counted, not listed
    cleaned = decontamination.clean(frame, bench)
    assert cleaned.columns == frame.columns
    assert sorted(row.doc_id for row in cleaned.collect()) == [2, 3, 4, 7, 10]


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontamination.leaks(none, bench).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")
    assert decontamination.clean(some, spark.createDataFrame([], "item_id long, text string")).count() == 1


def test_table(spark):
    name = "op6_decontamination"
    assert differences(queries()[name](spark, SF), connect(SF), oracle_sql()[name]) == []
