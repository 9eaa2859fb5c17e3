"""Hard negatives by exact search in windows of the inner product, over blocks on a Hilbert curve.

Candidates are ordered by label and by their place on a Hilbert curve, so that near vectors
lie together, and written to Parquet in blocks of one label with a zone map: the least and
the greatest value of each dimension.  For an anchor a the products with a block's vectors
lie, by interval arithmetic, between the sums over the dimensions of the lesser and of
the greater of a lo and a hi.  A window asks for its best rows with scores between two limits; the
zone maps alone, a few columns of the blocks, decide which blocks it reads.  First it reads
the blocks with the highest bounds; their k-th best score raises its lower limit; then it reads every
block that can still hold a row within its limits.  Windows meet zone maps
pack by pack, and blocks only the packs that chose them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kontor.llm import hilbert
from kontor.llm.topk import Best, products, whole
from kontor.operators.sizing import written

BLOCK = 512  # candidates
PACK = 256  # windows
ZONES = 1_024  # zone maps
BITS = 4  # of each dimension on the curve
FIRST = 2  # blocks a window reads before its limit is raised
# Windows whose best rows a task holds before it hands them on.
HELD = 16_384
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def candidates(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(key, label, x) of the rows that take part: none of the three null, all components finite, at least one."""
    pair = F.struct(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{label}`").alias("label"))
    rows = whole(df.select(pair.alias("row"), F.col(f"`{vector}`").alias("vector")), "row", "vector", scale)
    return rows.select("key.key", "key.label", "x").filter("key IS NOT NULL AND label IS NOT NULL AND size(x) > 0")


# --- blocks ---------------------------------------------------------------------
def _ranges(rows: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Least and greatest value of each dimension, for each length of vectors; two numbers a dimension reach the driver."""
    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, some in batch.groupby(batch["x"].str.len()):
                x = np.stack(some["x"].to_numpy())
                yield pd.DataFrame({"dim": dim, "place": np.arange(dim), "low": x.min(axis=0), "high": x.max(axis=0)})

    parts = rows.select("x").mapInPandas(part, "dim int, place int, low long, high long")
    table = parts.groupBy("dim", "place").agg(F.min("low").alias("low"), F.max("high").alias("high")).toPandas()
    table = table.sort_values(["dim", "place"])
    return {int(dim): (some["low"].to_numpy(float), some["high"].to_numpy(float)) for dim, some in table.groupby("dim")}


def _curve(rows: DataFrame) -> Column:
    """The place of `x` on the curve, its widest dimensions first."""
    ranges = rows.sparkSession.sparkContext.broadcast(_ranges(rows))

    @F.pandas_udf("binary")
    def place(x: pd.Series) -> pd.Series:
        found = pd.Series(index=x.index, dtype=object)
        for dim, some in x.groupby(x.str.len()):
            low, high = ranges.value[dim]
            order = np.argsort(low - high, kind="stable")
            cells = (np.stack(some.to_numpy()) - low) / np.maximum(high - low, 1) * 2**BITS
            cells = np.clip(cells.astype(np.int64), 0, 2**BITS - 1)[:, order]
            found[some.index] = hilbert.places(cells, BITS)
        return found

    return place("x")


def blocks(rows: DataFrame) -> DataFrame:
    """(block, dim, label, lo, hi, keys, x): candidates along the curve, at most `BLOCK` of one label to a block, written."""
    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        for batch in batches:
            for one in batch.itertuples(index=False):
                if held and (len(held) == BLOCK or (one.label, len(one.x)) != (held[0].label, len(held[0].x))):
                    yield packed(held)
                    held = []
                held.append(one)
        if held:
            yield packed(held)

    def packed(held: list) -> pd.DataFrame:
        x = np.stack([one.x for one in held])
        low, high = x.min(axis=0), x.max(axis=0)
        return pd.DataFrame({
            "block": [uuid.uuid4().hex], "dim": [x.shape[1]], "label": [held[0].label], "lo": [low], "hi": [high],
            "keys": [np.array([one.key for one in held], np.int64).tobytes()], "x": [_bytes(x)],
        })

    order = ["label", "curve", "key"]
    lying = rows.withColumn("curve", _curve(rows)).repartitionByRange(*order).sortWithinPartitions(*order)
    kind = rows.schema["label"].dataType.simpleString()
    schema = f"block string, dim int, label {kind}, lo array<long>, hi array<long>, keys binary, x binary"
    return written(lying.drop("curve").mapInPandas(pack, schema), "negatives-blocks")


def _bytes(x: np.ndarray) -> bytes:
    """Whole numbers in the least width that holds them all."""
    most = int(np.abs(x).max(initial=0))
    return x.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<i8").tobytes()


def _matrix(x: bytes, dim: int, rows: int) -> np.ndarray:
    return np.frombuffer(x, f"<i{len(x) // (dim * rows)}").reshape(rows, dim).astype(np.int64)


# --- packs ----------------------------------------------------------------------
def _packs(rows: DataFrame, size: int, vectors: tuple[str, ...]) -> DataFrame:
    """Rows of one vector length (`dim`) in packs of at most `size`: vectors as one binary, other columns as arrays; written."""
    others = [field for field in rows.schema if field.name not in ("dim", *vectors)]

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for one in batch.to_dict("records"):
                some = held.setdefault(one["dim"], [])
                some.append(one)
                if len(some) == size:
                    yield packed(one["dim"], held.pop(one["dim"]))
        for dim, some in held.items():
            yield packed(dim, some)

    def packed(dim: int, some: list) -> pd.DataFrame:
        lists = {field.name: [[one[field.name] for one in some]] for field in others}
        stacked = {name: [_bytes(np.stack([one[name] for one in some]))] for name in vectors}
        return pd.DataFrame({"dim": [dim], "pack": [uuid.uuid4().hex], **lists, **stacked})

    schema = ", ".join([
        "dim int, pack string", *(f"{field.name} array<{field.dataType.simpleString()}>" for field in others),
        *(f"{name} binary" for name in vectors),
    ])
    return written(rows.mapInPandas(pack, schema), "negatives-packs")


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Limits of the products of each vector with whatever lies between `low` and `high` of each block, by interval arithmetic."""
    a, low, high = (one.astype(float) for one in (a, low, high))
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    most = np.abs(a).max(initial=0) * max(np.abs(low).max(initial=0), np.abs(high).max(initial=0))
    slack = a.shape[1] ** 2 * most * 4e-16  # what rounding can take
    return up @ low.T + down @ high.T - slack, up @ high.T + down @ low.T + slack


def _met(packs: DataFrame, zones: DataFrame, same: bool, choose: Callable, schema: str) -> DataFrame:
    """`choose` for each pack of windows and each pack of zone maps of its length.

    The stated query set against all zone maps, in blocks; rows are packs on both sides.
    """
    theirs = zones.select(*(F.col(name).alias(f"z_{name}") for name in zones.columns))
    pairs = packs.repartition(max(1, packs.count())).crossJoin(theirs).filter("dim = z_dim")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for one in batch.itertuples(index=False):
                a = _matrix(one.x, one.dim, len(one.anchor))
                low, high = (_matrix(x, one.dim, len(one.z_block)) for x in (one.z_lo, one.z_hi))
                least, most = bounds(a, low, high)
                fits = np.equal.outer(np.asarray(one.label), np.asarray(one.z_label)) == same
                fits &= (most >= np.asarray(one.low)[:, None]) & (least <= np.asarray(one.high)[:, None])
                yield from choose(one, fits, np.minimum(most, np.asarray(one.high)[:, None]))

    return pairs.mapInPandas(run, schema)


def _first_blocks(pair, fits: np.ndarray, most: np.ndarray) -> Iterator[pd.DataFrame]:
    """The blocks with the highest bounds of each window."""
    ranked = np.where(fits, most, -np.inf)
    count = min(FIRST, ranked.shape[1])
    top = np.argpartition(-ranked, count - 1, axis=1)[:, :count]
    window, place = np.nonzero(np.take_along_axis(fits, top, axis=1))
    block = top[window, place]
    yield pd.DataFrame({
        "pack": pair.pack, "block": np.asarray(pair.z_block)[block], "window": window, "bound": ranked[window, block],
    })


def _all_blocks(pair, fits: np.ndarray, most: np.ndarray) -> Iterator[pd.DataFrame]:
    """Every block that can hold a row of a window."""
    some = np.flatnonzero(fits.any(axis=0))
    if len(some):
        yield pd.DataFrame({
            "pack": pair.pack, "block": np.asarray(pair.z_block)[some], "windows": [np.flatnonzero(fits[:, one]) for one in some],
        })


def first_choice(packs: DataFrame, zones: DataFrame, same: bool) -> DataFrame:
    """(pack, block, windows): for each window the `FIRST` blocks of the highest bounds."""
    found = _met(packs, zones, same, _first_blocks, "pack string, block string, window int, bound double")
    best = Window.partitionBy("pack", "window").orderBy(F.desc("bound"), "block")
    firsts = found.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= FIRST)
    return firsts.groupBy("pack", "block").agg(F.collect_set("window").alias("windows"))


def full_choice(packs: DataFrame, zones: DataFrame, same: bool) -> DataFrame:
    """(pack, block, windows): every block each window has to read."""
    return _met(packs, zones, same, _all_blocks, "pack string, block string, windows array<int>")


# --- search ---------------------------------------------------------------------
def _read(chosen: DataFrame, packs: DataFrame, stored: DataFrame, k: int) -> DataFrame:
    """(anchor, place, rank, key, score): the k best rows of each window within its limits, from the chosen blocks."""
    theirs = stored.select("block", F.col("keys").alias("b_keys"), F.col("x").alias("b_x"))
    rows = chosen.join(theirs, "block").join(packs.drop("label"), "pack")
    found = rows.mapInPandas(_searched(k), "anchor long, place int, key long, score long")
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _searched(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, tuple] = {}
        for batch in batches:
            for one in batch.itertuples(index=False):
                if one.pack not in held:
                    if sum(len(best.floor) for *_, best in held.values()) > HELD:
                        yield from map(_rows, held.values())
                        held = {}
                    held[one.pack] = (np.asarray(one.anchor), np.asarray(one.place), Best(len(one.anchor), k))
                _improve(held[one.pack], one)
        yield from map(_rows, held.values())

    return run


def _improve(held: tuple, row) -> None:
    """Add what a block holds for the windows that chose it."""
    anchors, _, best = held
    keys = np.frombuffer(row.b_keys, np.int64)
    x = _matrix(row.b_x, row.dim, len(keys))
    a = _matrix(row.x, row.dim, len(anchors))
    small = row.dim * int(np.abs(x).max(initial=0)) * int(np.abs(a).max(initial=0)) < 2**52
    windows = np.asarray(row.windows)
    different, which = np.unique(anchors[windows], return_index=True)
    scores = products(x, a[windows[which]].T, small)
    column = np.searchsorted(different, anchors[windows])
    for window, here in zip(windows, scores.T[column]):
        low = row.low[window]
        good = (here >= max(low, best.floor[window])) & (here <= row.high[window]) & ((here > low) | (keys <= row.upto[window]))
        good = np.flatnonzero(good & (keys != anchors[window]))
        if len(good):
            best.add(window, here[good], keys[good])


def _rows(held: tuple) -> pd.DataFrame:
    anchors, places, best = held
    window, place = np.nonzero(best.scores != LOWEST)
    return pd.DataFrame({
        "anchor": anchors[window], "place": places[window], "key": best.keys[window, place], "score": best.scores[window, place],
    })


def best_in_windows(windows: DataFrame, stored: DataFrame, zones: DataFrame, k: int, same: bool) -> DataFrame:
    """(anchor, place, rank, key, score): for each window (anchor, place, label, low, high, x) its k highest scores.

    Rows of the window's label take part if `same`, else those of any other; scores lie within
    low and high, and the anchor's own key is left out.  Ties go to the smaller key.  Behind the k-th
    best of the first blocks nothing is read on: no lower score, and at that score no greater key.
    """
    windows = windows.withColumns({"upto": F.lit(HIGHEST), "dim": F.size("x")})
    packs = _packs(windows, PACK, ("x",))
    first = _read(first_choice(packs, zones, same), packs, stored, k)
    limits = first.filter(F.col("rank") == k).select("anchor", "place", "score", "key")
    raised = windows.join(limits, ["anchor", "place"], "left").withColumns({
        "low": F.coalesce("score", "low"), "upto": F.coalesce("key", "upto"),
    }).drop("score", "key")
    packs = _packs(raised, PACK, ("x",))
    return _read(full_choice(packs, zones, same), packs, stored, k)


def mine(
    df: DataFrame, anchors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)

    Scores are inner products of vectors floor(scale * c).  An anchor's positives are its best
    `positives` other rows of its label; for each of them come the best `negatives` rows of
    other labels whose score is from `least` to `most` percent of the positive's.  Ties go to the smaller key;
    fewer rows give fewer ranks.  Rows with a null key, label or vector, with a null or not
    finite component, or with no component take no part, neither do vectors of another length than the
    anchor's.  Keys are integers.  Rows that share an anchor's key are its own and left out;
    repeated rows are candidates each; of anchors with one key the least by label and vector counts.
    """
    rows = candidates(df, key, vector, label, scale)
    own = F.min(F.struct("label", "x"))
    asked = candidates(anchors, key, vector, label, scale).groupBy(F.col("key").alias("anchor")).agg(own.alias("row"))
    asked = written(asked.select("anchor", "row.label", "row.x"), "negatives-anchors")
    stored = blocks(rows)
    zones = _packs(stored.select("dim", "block", "label", "lo", "hi"), ZONES, ("lo", "hi"))
    every = asked.select(
        "anchor", F.lit(0).alias("place"), "label", F.lit(LOWEST).alias("low"), F.lit(HIGHEST).alias("high"), "x",
    )
    best = best_in_windows(every, stored, zones, positives, True)
    found = written(best.select("anchor", F.col("rank").alias("place"), "key", "score"), "negatives-positives")
    # A negative product leaves no room between its parts.
    limits = found.filter("score >= 0").select(
        "anchor", "place", F.expr(f"(score * {least} + 99) div 100").alias("low"), F.expr(f"score * {most} div 100").alias("high"),
    )
    windows = limits.join(asked, "anchor").select("anchor", "place", "label", "low", "high", "x")
    hard = best_in_windows(windows, stored, zones, negatives, False)
    known = found.select("anchor", "place", F.col("key").alias("positive"), F.col("score").alias("positive_score"))
    return hard.join(known, ["anchor", "place"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("key").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )
