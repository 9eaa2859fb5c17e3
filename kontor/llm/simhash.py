"""Near-duplicates by SimHash and covering locality-sensitive hashing.

Every bit place gets a number from 1 to 2^(r+1) - 1, read as a vector over {0, 1}; the
mask of a non-zero vector v drops the places whose number has an even inner product
with v.  For any r places some v is orthogonal to all their numbers, so two
fingerprints that differ in at most r bits agree under at least one of the 2^(r+1) - 1
masks.  Nothing within the radius is missed, at any input.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontor.llm.components import components
from kontor.llm.frames import ROW, SPACE, field, packed, unpacked
from kontor.operators.sizing import written

BITS = 64
SEED = 42
SHINGLES_AT_ONCE = 4096
# A bucket beyond this many different fingerprints is covered anew in the bits its mask
# dropped, about half of them each time, until it has too few open bits to be larger.
BUCKET = 4096
SHARES = 512
ROWS_TOGETHER = 50_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_SPACE = re.compile(SPACE.encode())


# --- fingerprints ---------------------------------------------------------------
def fingerprint(text: str | None, size: int = 3) -> int:
    """A bit is 1 if it is set in over half the shingles' hashes; a text without words has 0."""
    words = [word for word in _SPACE.split((text or "").encode().translate(_LOWER)) if word]
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.append(0, ends[:-1] + 1)
    size = min(size, len(words))
    starts, ends = starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        spans = map(line.__getitem__, map(slice, starts[at:at + SHINGLES_AT_ONCE], ends[at:at + SHINGLES_AT_ONCE]))
        hashes = np.array(list(map(xxhash.xxh64_intdigest, spans, repeat(SEED))), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int = 3) -> Column:
    """The fingerprint as a signed long of the same bits."""

    @F.pandas_udf("long")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            values = np.fromiter((fingerprint(one, size) for one in texts), np.uint64, len(texts))
            yield pd.Series(values.view(np.int64))

    return each(text)


# --- covering masks -------------------------------------------------------------
def masks(radius: int, places: list[int]) -> list[int]:
    """Masks over the given bit places such that any `radius` of them are all dropped by some mask.

    The powers of two come first: more than `radius` places then have a basis among their
    numbers, and every mask fixes at least one of them.
    """
    numbers = sorted(range(1, 2 ** (radius + 1)), key=lambda number: (number.bit_count() > 1, number))
    given = {place: numbers[i % len(numbers)] for i, place in enumerate(places)}
    return [
        sum(1 << place for place, number in given.items() if (number & v).bit_count() % 2)
        for v in range(1, 2 ** (radius + 1))
    ]


def _signed(value: int) -> int:
    return value - 2**BITS if value >= 2 ** (BITS - 1) else value


def _places(mask: int) -> list[int]:
    return [i for i in range(BITS) if mask >> i & 1]


def links(prints: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) that connect all fingerprints `f` (distinct) within the radius, as spanning forests of buckets.

    `bucket` has to be at least 2^(radius + 1).
    """
    if bucket < 2 ** (radius + 1):
        raise ValueError("buckets too small for the radius")
    everything = 2**BITS - 1
    rows = written(_covered(prints.withColumn("open", F.lit(_signed(everything))), radius, [everything]), "simhash-rows")
    found = None
    while True:
        sizes = rows.groupBy("open", "key").agg(F.count("*").alias("n"))
        shared = written(sizes.filter("n > 1"), "simhash-buckets")
        held = rows.join(shared, ["open", "key"])
        calm = written(held.filter(F.col("n") <= bucket).select("f", "open", "key"), "simhash-calm")
        parts = calm.count() // ROWS_TOGETHER + 1
        together = calm.groupBy(F.pmod(F.xxhash64("open", "key"), F.lit(parts)).alias("part"))
        edges = written(together.applyInPandas(_forests(radius), "a long, b long"), "simhash-edges")
        found = edges if found is None else found.unionByName(edges)
        opened = [row.open % 2**BITS for row in shared.filter(F.col("n") > bucket).select("open").distinct().collect()]
        if not opened:
            return found
        again = held.filter(F.col("n") > bucket).select("f", "open")
        rows = written(_covered(again, radius, opened).distinct(), "simhash-rows")


def _covered(prints: DataFrame, radius: int, opened: list[int]) -> DataFrame:
    """Rows (f, open, key): each fingerprint under all masks of its open bits, and the bits open after that.

    `open` names the masks taken so far: the bits none of them has fixed.  How many values it
    can have depends on the radius alone.
    """
    plan = {mask: masks(radius, _places(mask)) for mask in opened}
    tables = F.create_map(*[
        part for mask, kept in plan.items()
        for part in (F.lit(_signed(mask)), F.array(*[F.lit(_signed(mask & ~one)) for one in kept]))
    ])
    rows = prints.select("f", F.explode(F.element_at(tables, F.col("open"))).alias("open"))
    return rows.withColumn("key", F.col("f").bitwiseAND(F.bitwise_not("open")))


def _forests(radius: int):
    """Of many buckets' fingerprints, edges that connect those of a bucket within the radius."""

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["open", "key", "f"])
        f = rows["f"].to_numpy().view(np.uint64)
        where = rows[["open", "key"]].to_numpy()
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        edges = [edge for one in np.split(f, cuts) for edge in _forest(one, radius)]
        return pd.DataFrame(np.array(edges, np.uint64).reshape(-1, 2).view(np.int64), columns=["a", "b"])

    return connect


def _forest(left: np.ndarray, radius: int) -> list[tuple]:
    """At most one edge for each fingerprint: breadth first through all within the radius."""
    edges, front = [], []
    while len(left):
        if not front:
            front, left = [left[0]], left[1:]
        near = np.bitwise_count(left ^ front[-1]) <= radius
        found = left[near].tolist()
        at = front.pop()
        edges += [(at, one) for one in found]
        front += [np.uint64(one) for one in found]
        left = left[~near]
    return edges


# --- the operator ---------------------------------------------------------------
def groups(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3) -> DataFrame:
    """(key, f, component): fingerprint and the smallest key of all rows reachable over links of at most `radius` bits.

    One row per row of `df`.  Copies fall together first, so only different fingerprints
    are compared.  A null text counts as empty; texts without words have fingerprint zero
    and are linked like any other.  A null key takes part, and a component of null keys
    alone is null.  An empty table gives no rows.
    """
    rows = written(df.select(F.col(f"`{key}`").alias("key"), fingerprints(F.col(f"`{text}`"), size).alias("f")), "simhash")
    return rooted(rows, radius).select("key", "f", "component")


def rooted(rows: DataFrame, radius: int) -> DataFrame:
    """Rows (key, f) with `root`, the smallest fingerprint of their component, and `component`, its smallest key.

    A fingerprint that holds more than one row in `SHARES` is joined by a broadcast, as all
    its rows would meet in one task; there are fewer than `SHARES` of them at any size.
    """
    prints = written(rows.groupBy("f").agg(F.min("key").alias("least"), F.count("*").alias("n")), "simhash-prints")
    placed = _placed(prints, radius)
    lowest = placed.groupBy("root").agg(F.min("least").alias("component"))
    named = written(placed.join(lowest, "root").select("f", "root", "component", "n"), "simhash-named")
    total = named.agg(F.sum("n")).first()[0] or 0
    often = F.col("n") * SHARES > total
    hot, others = named.filter(often).drop("n"), named.filter(~often).drop("n")
    crowded = rows.join(F.broadcast(hot), "f")
    rest = rows.join(F.broadcast(hot.select("f")), "f", "left_anti").join(others, "f")
    return crowded.unionByName(rest).select("key", "f", "root", "component")


def _placed(prints: DataFrame, radius: int) -> DataFrame:
    """Different fingerprints `f`, further columns kept, with the smallest one of their component."""
    roots = components(links(prints.select("f"), radius))
    return prints.join(roots.withColumnRenamed("node", "f"), "f", "left").withColumn("root", F.coalesce("root", "f"))


def hexadecimal(f: Column) -> Column:
    return F.lower(F.lpad(F.hex(f), BITS // 4, "0"))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3, radius: int = 3) -> DataFrame:
    """The rows of `df` with one row of each component left, that of the smallest key; columns unchanged.

    Of rows with that key the smallest fingerprint stays, of repeated rows any one.  A null
    key is larger than any other.  Null texts and empty tables as in `groups`.
    """
    prints = df.select(F.col(f"`{key}`").alias("key"), fingerprints(F.col(f"`{text}`"), size).alias("f"))
    prints = written(prints, "simhash")
    # Only the first key of a fingerprint can win, so copies fall together before the components are joined.
    keys = prints.groupBy("f", "key").agg(F.count("*").alias("n"))
    first = keys.groupBy("f").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "n")).alias("first"))
    placed = _placed(written(first.select("f", "first.*"), "simhash-prints"), radius)
    best = placed.groupBy("root").agg(F.min(F.struct("none", "key", "f", "n")).alias("best"))
    winners = written(best.select(F.col("best.key").alias("__key"), F.col("best.f").alias("__f"), "best.n"), "simhash-best")
    shared = prints.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1 OR key IS NULL")
    shared = written(shared.select(F.col("key").alias("__key")), "simhash-shared")
    rows = packed(df)
    if shared.isEmpty():
        return unpacked(rows.join(winners, field(key) == F.col("__key")).select(ROW))
    # Rows that share a key, or have none, are told apart by their fingerprints, which only they need again.
    own = winners.join(shared, winners["__key"].eqNullSafe(shared["__key"]), "left_anti")
    alone = rows.join(own, field(key) == F.col("__key")).select(ROW)
    marked = rows.join(shared, field(key).eqNullSafe(F.col("__key")), "left_semi")
    marked = marked.withColumn("f", fingerprints(field(text), size))
    kept = marked.join(winners, field(key).eqNullSafe(F.col("__key")) & (F.col("f") == F.col("__f")))
    repeated = kept.filter("n > 1").groupBy("__key", "__f").agg(F.first(ROW).alias(ROW)).select(ROW)
    return unpacked(alone.unionByName(kept.filter("n = 1").select(ROW)).unionByName(repeated))
