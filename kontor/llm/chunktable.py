"""A table of distinct text chunks and their ids, kept by a Python worker."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain, repeat

import numpy as np
import pyarrow as pa

# Chunks and characters a table may hold before it starts anew: about 100 MB.
MOST_CHUNKS, MOST_CHARACTERS = 500_000, 16_000_000


class ChunkTable:
    """Segments each distinct chunk once while it is held; ids lie in one flat array with offsets.

    `segment` gives the ids of each chunk of a list.
    """

    def __init__(self, segment: Callable[[list[str]], list[list[int]]]):
        self.segment = segment
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {}
        self.characters = 0
        self.offsets, self.ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def _rows(self, distinct: list[str]) -> np.ndarray:
        """The row of each distinct chunk; unknown ones are segmented in one call."""
        if len(self.place) > MOST_CHUNKS or self.characters > MOST_CHARACTERS:
            self._clear()
        rows = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(rows < 0)
        if len(unknown):
            new = [distinct[i] for i in unknown]
            found = self.segment(new)
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(lengths.sum()))
            rows[unknown] = np.arange(len(new)) + len(self.place)
            self.place.update(zip(new, rows[unknown].tolist()))
            self.characters += sum(map(len, new))
            self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(lengths)])
            self.ids = np.concatenate([self.ids, flat])
        return rows

    def joined(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks in their order, where each chunk's ids begin, and the end)."""
        coded = chunks.dictionary_encode()
        rows, codes = self._rows(coded.dictionary.to_pylist()), coded.indices.to_numpy()
        starts, lengths = self.offsets[rows], self.offsets[rows + 1] - self.offsets[rows]
        starts, lengths = starts[codes], lengths[codes]
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
        places = np.repeat(starts - ends[:-1], lengths)
        places += np.arange(ends[-1])
        return self.ids.take(places), ends
