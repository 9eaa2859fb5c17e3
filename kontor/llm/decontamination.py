"""Benchmark passages in documents: SimHash over item-sized windows, a multi-index on Hamming blocks, exact check.

DataFrame functions only.  A text is its lower-case runs of letters and digits, in
shingles of five words.  For an item of m shingles a window is m shingles of a document.
Windows start at every offset and are clipped at the text's edges; those that hold too few
shingles of any item of m shingles to be similar to one are not cut.  Their
fingerprints are looked up in the index of the items of m shingles: of 64 bits in 8
blocks, two fingerprints that differ in at most `RADIUS` bits differ in at most
RADIUS // 8 bits of some block, and the index holds every item under all such
neighbours of each of its blocks.  A candidate stays if the shingles of window and
item, weighted by how often they occur, have a similarity (sum of least weights by
sum of greatest) of `threshold`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.frames import ROW, field, packed, unpacked
from kontor.operators.sizing import written

SHINGLE = 5
THRESHOLD = 0.8
# Odds computed for 64 independent sign bits, not measured: over 23 bits differ at similarity 0.8 less than once in 100,000, clipped 3 times in 10,000.
RADIUS = 23
BLOCKS = 8
BLOCK_BITS = 64 // BLOCKS

WORDS = "filter(split(lower({text}), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w != '')"
SHINGLES = (
    "CASE WHEN size(words) < {n} THEN array() ELSE transform(sequence(0, size(words) - {n}), "
    "i -> xxhash64({words})) END"
).format(n=SHINGLE, words=", ".join(f"words[i + {k}]" for k in range(SHINGLE)))
# A bit is 1 if it is set in over half the shingles of `part`.
PRINT = (
    "aggregate(sequence(0, 63), 0L, (f, b) -> f | shiftleft(cast(2 * aggregate(part, 0L, "
    "(n, h) -> n + (shiftright(h, b) & 1)) > size(part) AS bigint), b))"
)
# Bitmaps that drop rows before an exchange have 16 bits for each hash, between these powers of two: 2 MB at most.
LEAST_BITS, MOST_BITS = 16, 24
# The starts of all windows of m shingles that hold `k` of the sorted positions `ps`, each once.
STARTS = (
    "CASE WHEN size(ps) < {k} THEN array() ELSE flatten(transform(sequence(0, size(ps) - {k}), i -> "
    "CASE WHEN greatest(ps[i + {k} - 1] - m, get(ps, i - 1)) < ps[i] "
    "THEN sequence(greatest(ps[i + {k} - 1] - m, get(ps, i - 1)) + 1, ps[i]) ELSE array() END)) END"
)
WINDOW = ("text_key", "start", "stop", "m")
BLOCK = f"shiftright(f, {BLOCK_BITS} * block) & {2**BLOCK_BITS - 1}"


def shingled(df: DataFrame, text: str) -> DataFrame:
    """Add `words` and `shingles`, the 64-bit hashes of the text's shingles in order."""
    return df.withColumn("words", F.expr(WORDS.format(text=text))).withColumn("shingles", F.expr(SHINGLES))


def held(hashes: DataFrame, column: str):
    """A test of whether a hash may be among the hashes of a written table: a bitmap, passed on as a scalar subquery."""
    bits = max(LEAST_BITS, min(MOST_BITS, (16 * hashes.count()).bit_length()))
    place = hashes.select(F.expr(f"shiftrightunsigned({column}, {64 - bits})").alias("place"))
    marks = place.select(F.expr("shiftright(place, 6)").alias("id"), F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("mark"))
    marks = marks.groupBy("id").agg(F.bit_or("mark").alias("mark"))
    every = hashes.sparkSession.range(2 ** (bits - 6)).join(marks, "id", "left")
    rows = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("mark", F.lit(0)).alias("mark")))).alias("rows"))
    words = rows.select(F.transform("rows", lambda one: one["mark"])).scalar()

    def may_hold(number: Column) -> Column:
        at = F.shiftrightunsigned(number, 64 - bits)
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        return F.call_function("shiftright", word, at.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

    return may_hold


def text_key(text: Column) -> Column:
    return F.md5(text.cast("binary"))


def items(benchmark: DataFrame, item: str, text: str) -> DataFrame:
    """(item, item_id, m, part) of different benchmark rows with at least one shingle."""
    rows = benchmark.select(F.col(f"`{item}`").alias("item_id"), F.col(f"`{text}`").alias("text")).distinct()
    named = rows.withColumn("item", F.md5(F.to_json(F.struct("item_id", "text")).cast("binary")))
    cut = shingled(named, "text").filter(f"size(words) >= {SHINGLE}")
    return cut.select("item", "item_id", F.size("shingles").alias("m"), F.col("shingles").alias("part"))


def places(texts: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """(text_key, start, stop, m): the windows, at every offset, with enough shingles of items of m shingles to be similar.

    A window of l shingles, c of them in some item of m, has similarity c / (l + m - c) at
    most.  So it needs 2 * m * threshold / (1 + threshold) of them within the text, and,
    clipped at an edge, m * threshold at least.
    """
    shingles = written(known.select("m", F.explode("part").alias("h")).distinct(), "leak-shingles")
    shared = held(shingles, "h")
    # Outer, or the optimiser tests the array's size below the words' projection, cutting the text for each word.
    each = F.posexplode_outer("shingles").alias("p", "h")
    rows = shingled(texts, "text").select("text_key", F.size("shingles").alias("n"), each)
    rows = rows.filter(shared(F.col("h"))).join(shingles, "h")
    rows = rows.groupBy("text_key", "m").agg(F.first("n").alias("n"), F.collect_set("p").alias("ps"))
    # Rounding must not drop a window that just reaches the threshold; the exact check decides.
    whole, clipped = (f"greatest(1, cast(ceil({x} * m - 1e-6) AS int))" for x in (2 * threshold / (1 + threshold), threshold))
    rows = rows.select("text_key", "m", "n", F.sort_array("ps").alias("ps"), F.expr(whole).alias("k"), F.expr(clipped).alias("e"))
    rows = rows.filter("size(ps) >= e").withColumn("inside", F.expr(STARTS.format(k="k"))).withColumn("outside", F.expr(STARTS.format(k="e")))
    at = F.explode(F.expr("concat(filter(inside, s -> s >= 0 AND s <= n - m), filter(outside, s -> s < 0 OR s > n - m))"))
    rows = rows.select("text_key", "m", "n", at.alias("at"))
    return rows.select(
        "text_key", F.greatest("at", F.lit(0)).alias("start"), F.least(F.col("at") + F.col("m"), "n").alias("stop"), "m"
    ).distinct()


def windows(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """(text_key, start, stop, m, part): the shingles of each window; equal texts are cut once."""
    found = spans.select("text_key", F.xxhash64("text_key").alias("h")).distinct()
    likely = texts.filter(held(found, "h")(F.xxhash64("text_key")))
    once = likely.groupBy("text_key").agg(F.first("text").alias("text"))  # copies go before anything is moved
    wanted = once.join(found, "text_key", "left_semi")
    cut = shingled(wanted, "text").select("text_key", "shingles").join(spans, "text_key")
    return cut.select(*WINDOW, F.expr("slice(shingles, start + 1, stop - start)").alias("part"))


def candidates(cut: DataFrame, known: DataFrame, radius: int) -> DataFrame:
    """WINDOW and item of all windows and items of m shingles whose fingerprints differ in at most `radius` bits."""
    spread = radius // BLOCKS
    near = f"filter(sequence(0, {2**BLOCK_BITS - 1}), x -> bit_count(x) <= {spread})"
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("block")
    index = known.select("item", "m", F.expr(PRINT).alias("f")).select("item", "m", "f", blocks)
    index = index.select("item", "m", F.col("f").alias("g"), "block", F.expr(BLOCK).alias("own"), F.explode(F.expr(near)).alias("x"))
    index = index.withColumn("value", F.col("own").bitwiseXOR(F.col("x"))).drop("own", "x")
    looked = cut.select(*WINDOW, F.expr(PRINT).alias("f")).select(*WINDOW, "f", blocks)
    looked = looked.withColumn("value", F.expr(BLOCK))
    found = looked.join(index, ["m", "block", "value"]).filter(F.bit_count(F.col("f").bitwiseXOR(F.col("g"))) <= radius)
    return found.select(*WINDOW, "item").distinct()


def verified(found: DataFrame, cut: DataFrame, known: DataFrame, threshold: float) -> DataFrame:
    """WINDOW, item and similarity of the candidates whose weighted shingles are similar enough."""
    ours = cut.select(*WINDOW, F.explode("part").alias("h")).groupBy(*WINDOW, "h").agg(F.count("*").alias("a"))
    theirs = known.select("item", F.explode("part").alias("h")).groupBy("item", "h").agg(F.count("*").alias("b"))
    common = found.join(ours, list(WINDOW)).join(theirs, ["item", "h"])
    common = common.groupBy(*WINDOW, "item").agg(F.sum(F.least("a", "b")).alias("common"))
    similarity = F.col("common") / (F.col("stop") - F.col("start") + F.col("m") - F.col("common"))
    return common.withColumn("similarity", similarity).filter(F.col("similarity") >= threshold).drop("common")


def matches(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
    threshold: float = THRESHOLD, radius: int = RADIUS,
) -> DataFrame:
    """(text_key, item_ids, n_items, similarity) of every different text that holds a benchmark item.

    Null texts and texts or items of fewer than five words match nothing; equal texts share
    a row; an item that occurs more than once in the benchmark counts once by id and text;
    null item ids are counted but not listed.  Either table may be empty.
    """
    known = written(items(benchmark, item, item_text), "leak-items")
    texts = df.select(text_key(F.col(f"`{text}`")).alias("text_key"), F.col(f"`{text}`").alias("text")).filter("text IS NOT NULL")
    spans = written(places(texts, known, threshold), "leak-places")
    cut = written(windows(texts, spans), "leak-windows")
    sure = verified(candidates(cut, known, radius), cut, known, threshold)
    return sure.join(known.select("item", "item_id"), "item").groupBy("text_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.count_distinct("item").alias("n_items"),
        F.max("similarity").alias("similarity"),
    )


def leaks(df: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """(key, item_ids, n_items, similarity) of every row that holds a benchmark item; repeated rows each."""
    found = written(matches(df, benchmark, text, **options), "leaks")
    rows = df.select(F.col(f"`{key}`").alias("key"), text_key(F.col(f"`{text}`")).alias("text_key"))
    return rows.join(found, "text_key").select("key", "item_ids", "n_items", "similarity")


def clean(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of `df` that hold no benchmark item, columns unchanged; rows with a null text stay."""
    found = written(matches(df, benchmark, text, **options).select("text_key", F.xxhash64("text_key").alias("h")), "leaks")
    rows = packed(df).withColumn("text_key", text_key(field(text)))
    suspect = F.coalesce(held(found, "h")(F.xxhash64("text_key")), F.lit(False))
    checked = rows.filter(suspect).join(found, "text_key", "left_anti")  # only these rows are moved
    return unpacked(rows.filter(~suspect).select(ROW).unionByName(checked.select(ROW)))
