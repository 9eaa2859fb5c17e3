"""SentencePiece ids of whole texts by a table of distinct chunks, and the way back.

The library turns each blank of a text into a marker, puts one more before it, and
merges characters to pieces.  Where no piece holds a marker behind another character, no
merge can cross a marker that follows one: a text falls into chunks, each a run of markers
with the characters up to the next run, and the ids of the text are those of its chunks
one after the other.  Each distinct chunk of a batch of rows is segmented by the library
once, unless the worker's table still holds it, and the ids are joined back by position.
That costs no exchange; a lost task is read and segmented again with the same result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.llm.chunktable import ChunkTable

MARK = "▁"
# Characters handled at once; a longer text is cut where a chunk begins.
AT_ONCE = 4_000_000
BORDER = re.compile(r"(?<=[^ ]) (?=[^ ])")


class Pieces:
    """A model with its table; refuses models whose texts do not fall into chunks."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        require_chunks(path)
        self.mark = self.model.piece_to_id(MARK)
        self.table = ChunkTable(self._segment)

    def _segment(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks without their first marker, which the library puts there; it leaves nothing where nothing follows."""
        found = self.model.encode(chunks, num_threads=1)
        return [ids or [self.mark] for ids in found]

    def encoded(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        parts = [(i, part) for i, text in enumerate(texts) for part in _parts(text)]
        at = 0
        held: list[np.ndarray] = []
        while at < len(parts):
            stop, size = at, 0
            while stop < len(parts) and (stop == at or size + len(parts[stop][1]) <= AT_ONCE):
                size += len(parts[stop][1])
                stop += 1
            for (text, _), ids in zip(parts[at:stop], self._some([part for _, part in parts[at:stop]])):
                if held and text != current:
                    yield np.concatenate(held)
                    held = []
                current = text
                held.append(ids)
            at = stop
        if held:
            yield np.concatenate(held)

    def _some(self, texts: list[str]) -> Iterator[np.ndarray]:
        chunks, ends = chunked(pa.array(texts, pa.string()))
        ids, starts = self.table.joined(chunks)
        bounds = starts[ends]
        for start, end in zip(bounds[:-1], bounds[1:]):
            yield ids[start:end]

    def decoded(self, ids: list[int]) -> str:
        return self.model.decode(ids)


def require_chunks(path: str) -> None:
    """Raise unless chunks can be segmented on their own: a plain normaliser, a marker before the text, none inside a piece."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rule = model.normalizer_spec
    plain = not rule.precompiled_charsmap and rule.add_dummy_prefix and rule.escape_whitespaces and not rule.remove_extra_whitespaces
    named = any(one.type == one.USER_DEFINED for one in model.pieces)
    inside = any(MARK in one.piece.lstrip(MARK) for one in model.pieces)
    single = any(one.piece == MARK for one in model.pieces)
    if not plain or named or inside or not single or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError(f"the pieces of {path} can cross markers")


def _parts(text: str) -> Iterator[str]:
    """The text, cut at single blanks between other characters where it is long; the blank is the next part's first marker."""
    text = text.replace(MARK, " ")
    start = 0
    while len(text) - start > AT_ONCE:
        border = BORDER.search(text, start + AT_ONCE - 1)
        if border is None:
            break
        yield text[start : border.start()]
        start = border.end()
    yield text[start:]


def chunked(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All chunks of the texts, each without its first marker, and the number of chunks before each text and in all.

    Cut at every blank, a run of blanks leaves empty words: those go to the word behind the
    run as its further markers, or, at the end of a text, make a chunk of markers alone.
    """
    cut = pc.split_pattern(texts, " ")
    offsets = cut.offsets.to_numpy().astype(np.int64)
    words = cut.values
    empty = pc.equal(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    counts = np.diff(offsets)
    last = np.zeros(len(words), bool)
    last[offsets[1:] - 1] = True
    dropped = empty & ~last
    no_text = (counts == 1) & empty[offsets[:-1]]
    dropped[offsets[:-1][no_text]] = True
    kept = np.flatnonzero(~dropped)
    before = np.concatenate([np.zeros(1, np.int64), np.cumsum(~dropped)])
    if len(kept) < len(words):
        first = np.repeat(offsets[:-1], counts)[kept]
        previous = np.maximum(np.concatenate([[-1], kept[:-1]]), first - 1)
        blanks = pc.binary_repeat(" ", pa.array(kept - previous - 1))
        words = pc.binary_join_element_wise(blanks, words.take(pa.array(kept)), "")
    return words, before[offsets]


_PIECES: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """One model for each Python worker, kept over its tasks."""
    if path not in _PIECES:
        _PIECES[path] = Pieces(path)
    return _PIECES[path]


def encode(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the ids of each row's whole text, without begin or end ids.

    A null text counts as an empty one, which has no ids.  Every row gives one row, null and
    repeated keys too.  `model` is a file that every executor can read.
    """
    rows = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pieces(model)
        for batch in batches:
            ids, ends = [], [0]
            for one in known.encoded(pc.fill_null(batch.column("text"), "").to_pylist()):
                ids.append(one)
                ends.append(ends[-1] + len(one))
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]), pa.int32())
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("key"), lists], ["key", "ids"])

    return rows.mapInArrow(run, schema)


def decoded(ids: Column, model: str) -> Column:
    """The text the library makes of an array of ids; null for null."""
    @F.arrow_udf("string")
    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = pieces(model)
        for batch in batches:
            yield pa.array([None if one is None else known.decoded(one) for one in batch.to_pylist()], pa.string())

    return each(ids)
