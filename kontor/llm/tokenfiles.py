"""Token ids as raw binary shards with a constant-time index by document key.

A shard is three files in the shared folder: `.bin`, the ids of its documents one after
the other, unsigned little-endian, 16 or 32 bits by the size of the vocabulary; `.keys`,
an Arrow file with key, offset and number of ids of each document in file order; and
`.mph`, a minimal perfect hash from a key to its documents, with a 32-bit fingerprint of
each key, so that a key that is not there is told from one that is.  The manifest is a
Parquet table with one row for each shard.  Task attempts write files of their own
names, and only the names of those that succeeded reach the manifest.
"""

from __future__ import annotations

import io
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kontor.llm import mph
from kontor.llm.chunktable import ChunkTable
from kontor.session import scratch_path

# Bytes of text and number of pieces handled at once.
BYTES_AT_ONCE, PIECES_AT_ONCE = 8_000_000, 1_000_000
READ_BYTES = 8 * 1024 * 1024


# --- encoding -------------------------------------------------------------------
class PieceEncoder:
    """The tokenizer's ids of whole texts, with a table of pieces.

    A byte-level BPE encodes word by word.  A single space between two characters that
    are no white space always begins a word, a single line break there is one, and an ASCII mark other than
    an apostrophe behind a Latin letter begins one: the text is cut before all three.  Each different piece of
    a batch is encoded once, unless the table still holds it, and the ids are joined back by
    position.  A piece that is one word of Latin letters goes to the tokenizer's model at once, all
    others through the whole tokenizer.  Texts of other tokenizers are not cut.
    """

    WORD = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
    MARKS_KEPT = 50_000

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core a task
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = id_type(self.tokenizer)
        self.model = self.tokenizer.model if _byte_level(self.tokenizer) else None
        self.begins = _beginning_marks(self.tokenizer)
        self.table = ChunkTable(self.segmented)
        self.marks: dict[str, list[int]] = {}

    def encoded(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        texts = texts.cast(pa.string())
        if self.model is None:
            yield from (np.array(self.ids(text), self.dtype) for text in texts.to_pylist())
            return
        pieces, bounds = cut(texts, self.begins)
        held, tokens = [np.zeros(0, self.dtype)], [np.zeros(1, np.int64)]
        for at in range(0, len(pieces), PIECES_AT_ONCE):
            ids, ends = self.table.joined(pieces.slice(at, PIECES_AT_ONCE))
            held.append(ids.astype(self.dtype))
            tokens.append(ends[1:] + tokens[-1][-1])
        ids, places = np.concatenate(held), np.concatenate(tokens)[bounds]
        for start, end in zip(places[:-1], places[1:]):
            yield ids[start:end]

    def segmented(self, pieces: list[str]) -> list[list[int]]:
        """Ids of pieces the table does not hold."""
        tokenize, blank = self.model.tokenize, BYTE_LETTERS[ord(" ")]
        found = []
        for piece in pieces:
            if piece.isascii():  # ASCII letters stand for themselves
                if piece[0] == " " and piece[1:].isalpha():
                    found.append([token.id for token in tokenize(blank + piece[1:])])
                elif piece.isalpha():
                    found.append([token.id for token in tokenize(piece)])
                else:
                    found.append(self.other(piece))
            elif self.WORD.fullmatch(piece):
                letters = piece.encode().decode("latin-1").translate(BYTE_LETTERS)
                found.append([token.id for token in tokenize(letters)])
            else:
                found.append(self.other(piece))
        return found

    def other(self, piece: str) -> list[int]:
        """Ids of a piece that is not one word; those of few characters are remembered beyond the table."""
        if len(piece) > 1 and piece[0] == "\n" and not piece[1].isspace():
            return self.other("\n") + self.segmented([piece[1:]])[0]
        if len(piece) > 3:
            return self.ids(piece)
        if piece not in self.marks:
            if len(self.marks) > self.MARKS_KEPT:
                self.marks = {}
            self.marks[piece] = self.ids(piece)
        return self.marks[piece]

    def ids(self, piece: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([piece], add_special_tokens=False)[0].ids


def _beginning_marks(tokenizer) -> np.ndarray:
    """Which bytes begin a word behind a Latin letter: ASCII marks, but no apostrophe, and none that does so inside an added token."""
    begins = np.zeros(256, bool)
    begins[[byte for byte in range(33, 127) if not chr(byte).isalnum() and byte != ord("'")]] = True
    for token in tokenizer.get_added_tokens_decoder().values():
        begins[[ord(b) for a, b in zip(token.content, token.content[1:]) if a.isalpha() and b.isascii()]] = False
    return begins


def _letters() -> np.ndarray:
    letters = np.zeros(256, bool)
    letters[[*range(65, 91), *range(97, 123)]] = True
    return letters


LETTERS = _letters()


def _no_white_space() -> np.ndarray:
    """Which bytes are no white space of their own: ASCII controls 9 to 13 and 28 to 31, and the blank."""
    free = np.ones(256, bool)
    free[[*range(9, 14), *range(28, 33)]] = False
    return free


FREE = _no_white_space()


def _wide_space(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Where three bytes are a white space character in UTF-8; for one of two bytes, the first two."""
    general = (three <= 0x8A) | np.isin(three, (0xA8, 0xA9, 0xAF))
    return (
        ((one == 0xC2) & np.isin(two, (0x85, 0xA0))) | ((one == 0xE1) & (two == 0x9A) & (three == 0x80))
        | ((one == 0xE2) & (two == 0x80) & general) | ((one == 0xE2) & (two == 0x81) & (three == 0x9F))
        | ((one == 0xE3) & (two == 0x80) & (three == 0x80))
    )


def cut(texts: pa.Array, begins: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """All pieces of the texts, and the number of pieces before each text and in all.

    A piece begins with its text, with a blank or line break that stands alone, or behind an
    ASCII letter with one of the marks in `begins`.  Pieces are slices of the texts' own bytes.
    """
    if not len(texts):
        return pa.array([], pa.string()), np.zeros(1, np.int64)
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.zeros(0, np.uint8) if buffers[2] is None else np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    at = np.flatnonzero((data == 32) | (data == 10))
    at = at[~edge[at] & ~edge[at + 1]]
    before, after = data[at - 1], data[at + 1]
    at = at[FREE[before] & FREE[after]]
    wide = np.flatnonzero((data[at - 1] >= 128) | (data[at + 1] >= 128))
    if len(wide):
        near = at[wide]
        byte = lambda step: data.take(near + step, mode="clip")
        space = _wide_space(byte(-3), byte(-2), byte(-1)) | _wide_space(byte(-2), byte(-1), byte(0)) | _wide_space(byte(1), byte(2), byte(3))
        at = np.delete(at, wide[space])
    marks = np.flatnonzero(begins[data[1:]] & LETTERS[data[:-1]]) + 1
    starts = np.sort(np.concatenate([offsets[:-1][np.diff(offsets) > 0], at, marks[~edge[marks]]]))
    ends = np.append(starts, len(data)).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data)))
    return pieces, np.searchsorted(starts, offsets)


def _byte_level(tokenizer) -> bool:
    """Whether words reach the model unchanged but for the letters that stand for bytes."""
    parts = json.loads(tokenizer.to_str())
    rule = parts["pre_tokenizer"] or {}
    plain = rule.get("type") == "ByteLevel" and not rule["add_prefix_space"] and rule.get("use_regex", True)
    own = any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in parts["added_tokens"])
    return plain and not own and parts["normalizer"] is None


def _byte_letters() -> dict[int, str]:
    """Fixed by the byte-level format: printable Latin-1 stands for itself, the rest for 256 upwards in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {byte: chr(byte) for byte in shown} | {byte: chr(256 + i) for i, byte in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()


def id_type(tokenizer) -> str:
    return "<u2" if tokenizer.get_vocab_size(with_added_tokens=True) <= 2**16 else "<u4"


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker, kept over its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


# --- shards ---------------------------------------------------------------------
def key_numbers(keys: list) -> np.ndarray:
    """64 bits of each key's text; a null key is a key of its own."""
    texts = (b"\x00" if key is None else b"\x01" + str(key).encode() for key in keys)
    return np.fromiter((xxhash.xxh64_intdigest(text) for text in texts), np.uint64, len(keys))


def fingerprints(numbers: np.ndarray) -> np.ndarray:
    return (mph.mixed(numbers, 2**20) >> np.uint64(32)).astype("<u4")


def index_bytes(keys: list) -> bytes:
    """The index of a shard whose documents have these keys, equal keys side by side.

    Keys whose 64 bits agree with another key's are kept beside the hash, by their text.
    """
    new = [i for i, key in enumerate(keys) if i == 0 or key != keys[i - 1]]
    numbers = key_numbers([keys[i] for i in new])
    unique, counts = np.unique(numbers, return_counts=True)
    clash = np.isin(numbers, unique[counts > 1])
    table = mph.build(numbers[~clash])
    firsts = np.array(new, "<i8")
    lengths = np.diff(np.append(firsts, len(keys))).astype("<i8")
    order = mph.places(table, numbers[~clash])
    slots = {"first": firsts, "count": lengths, "fingerprint": fingerprints(numbers)}
    placed = {}
    for name, values in slots.items():
        placed[name] = np.zeros(len(order), values.dtype)
        placed[name][order] = values[~clash]
    beside = [str(keys[new[i]]) for i in np.flatnonzero(clash)]
    extra = {"beside": np.array(beside, "U"), "beside_first": firsts[clash], "beside_count": lengths[clash]}
    out = io.BytesIO()
    np.savez(out, **table, **placed, **extra)
    return out.getvalue()


class Shard:
    """Reads one shard."""

    def __init__(self, uri: str, name: str, dtype: str):
        self.fs, folder = pa.fs.FileSystem.from_uri(uri)
        self.path, self.dtype, self.width = f"{folder}/{name}", dtype, np.dtype(dtype).itemsize
        with self.fs.open_input_file(self.path + ".mph") as file:
            with np.load(io.BytesIO(file.read())) as arrays:
                self.index = dict(arrays)
        with self.fs.open_input_file(self.path + ".keys") as file:
            self.table = pa.ipc.open_file(file).read_all()
        self.offsets = self.table["offset"].to_numpy()
        self.lengths = self.table["n_ids"].to_numpy()

    def keys(self) -> list:
        return self.table["key"].to_pylist()

    def find(self, keys: list) -> tuple[np.ndarray, np.ndarray]:
        """First document and number of documents of each key; number 0 if it is not in the shard."""
        numbers = key_numbers(keys)
        place = mph.places(self.index, numbers)
        known = np.flatnonzero(place >= 0)
        known = known[self.index["fingerprint"][place[known]] == fingerprints(numbers[known])]
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known], count[known] = self.index["first"][place[known]], self.index["count"][place[known]]
        if len(self.index["beside"]):
            where = {text: i for i, text in enumerate(self.index["beside"].tolist())}
            for i, key in enumerate(keys):
                if (j := where.get(str(key))) is not None:
                    first[i], count[i] = self.index["beside_first"][j], self.index["beside_count"][j]
        return first, count

    def payloads(self, documents: np.ndarray) -> Iterator[np.ndarray]:
        """The ids of documents by their ordinal; neighbours are read together."""
        with self.fs.open_input_file(self.path + ".bin") as file:
            low = high = 0
            block = b""
            for i in documents:
                start, end = int(self.offsets[i]) * self.width, int(self.offsets[i] + self.lengths[i]) * self.width
                if not low <= start <= end <= high:
                    block = file.read_at(max(READ_BYTES, end - start), start)
                    low, high = start, start + len(block)
                yield np.frombuffer(block, self.dtype, (end - start) // self.width, start - low)


@dataclass(frozen=True)
class TokenFiles:
    """The folder of the shards, the manifest's path, and how ids are stored."""

    folder: str
    manifest: str
    dtype: str
    key_type: T.DataType

    def shards(self, spark: SparkSession) -> DataFrame:
        """(shard, name, documents, ids, first_key, last_key, start): one row for each shard."""
        rows = spark.read.schema(_manifest_schema(self.key_type)).parquet(self.manifest)
        ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
        return rows.withColumn("start", F.coalesce(F.sum("ids").over(ahead), F.lit(0)).cast("long"))


def _manifest_schema(key_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.LongType()), T.StructField("name", T.StringType()),
        T.StructField("documents", T.LongType()), T.StructField("ids", T.LongType()),
        T.StructField("first_key", key_type), T.StructField("last_key", key_type),
    ])


def write_tokens(
    df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 0,
    folder: str | None = None,
) -> TokenFiles:
    """Encode every whole text, append `end_id`, and write shards in ascending order of the key.

    Null keys come first; rows with equal keys are ordered by their text's hash, so that
    a key that many rows share is spread over shards; equal rows stay together.  A null
    text is empty and has only the end id.  An empty table has an empty manifest.
    `folder` is a URI all executors can write, by default in the shared folder.
    """
    from tokenizers import Tokenizer

    spark = df.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    dtype, key_type = id_type(Tokenizer.from_file(tokenizer)), df.schema[key].dataType
    rows = df.select(
        F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
        F.xxhash64(F.col(f"`{text}`")).alias("tie"),
    )
    dealt = rows.repartitionByRange("key", "tie").sortWithinPartitions("key", "tie").select("key", "text")
    schema = _manifest_schema(key_type)

    def write(batches):
        yield from _write_shard(batches, folder, tokenizer, dtype, end_id)

    manifest = f"{folder}/manifest"
    dealt.mapInArrow(write, schema).write.parquet(manifest)
    return TokenFiles(folder, manifest, dtype, key_type)


def _portions(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts in portions of about `BYTES_AT_ONCE`; a longer one is a portion of its own."""
    upto = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        stop = int(np.searchsorted(upto, (upto[at - 1] if at else 0) + BYTES_AT_ONCE, side="right"))
        stop = max(stop, at + 1)
        yield texts.slice(at, stop - at)
        at = stop


def _write_shard(batches, folder, tokenizer, dtype, end_id) -> Iterator[pa.RecordBatch]:
    """Write the documents of one task; its row of the manifest, none if it has no documents."""
    batch = next((one for one in batches if one.num_rows), None)
    if batch is None:
        return
    fs, path = pa.fs.FileSystem.from_uri(folder)
    fs.create_dir(path, recursive=True)
    shard = TaskContext.get().partitionId()
    name = f"shard-{shard:06d}-{uuid.uuid4().hex}"
    end, encode = np.array([end_id], dtype).tobytes(), encoder(tokenizer).encoded
    keys, lengths = [], []
    with fs.open_output_stream(f"{path}/{name}.bin") as out:
        while batch is not None:
            keys.append(batch.column(0))
            for part in _portions(batch.column(1)):
                for ids in encode(part):
                    out.write(ids.tobytes() + end)
                    lengths.append(len(ids) + 1)
            batch = next(batches, None)
    ids = np.array(lengths, np.int64)
    column = pa.chunked_array(keys)
    table = pa.table({"key": column, "offset": np.cumsum(ids) - ids, "n_ids": ids})
    with fs.open_output_stream(f"{path}/{name}.keys") as out, pa.ipc.new_file(out, table.schema) as writer:
        writer.write_table(table)
    with fs.open_output_stream(f"{path}/{name}.mph") as out:
        out.write(index_bytes(column.to_pylist()))
    yield pa.RecordBatch.from_pydict({
        "shard": [shard], "name": [name], "documents": [len(ids)], "ids": [int(ids.sum())],
        "first_key": column.slice(0, 1).combine_chunks(), "last_key": column.slice(len(ids) - 1).combine_chunks(),
    })


def read_back(spark: SparkSession, files: TokenFiles) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, looked up and read from the files.

    `start` counts the ids of all documents before it; the checksum is over the ids as
    little-endian unsigned 32-bit integers.
    """
    schema = T.StructType([
        T.StructField("key", files.key_type), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ])
    folder, dtype = files.folder, files.dtype

    def read(batches):
        for batch in batches:
            for name, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield _read_shard(Shard(folder, name, dtype), start)

    shards = files.shards(spark).select("name", "start")
    return shards.repartition(max(1, shards.count())).mapInArrow(read, schema)


def _read_shard(shard: Shard, start: int) -> pa.RecordBatch:
    keys = shard.keys()
    distinct = [key for i, key in enumerate(keys) if i == 0 or key != keys[i - 1]]
    first, count = shard.find(distinct)
    documents = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count)])
    crc = [zlib.crc32(ids.astype("<u4").tobytes()) for ids in shard.payloads(documents)]
    return pa.RecordBatch.from_pydict({
        "key": shard.table["key"].combine_chunks().take(pa.array(documents)),
        "start": shard.offsets[documents] + start, "n_tokens": shard.lengths[documents],
        "ids_crc32": pa.array(crc, pa.int64()),
    })


def lookup(files: TokenFiles, wanted: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, ids) of every document whose key is in `wanted`; unknown and null keys give no row.

    A key goes to the shards whose range holds it; there the hash gives its place at once.
    """
    shards = files.shards(wanted.sparkSession).select("name", "first_key", "last_key")
    routed = wanted.select(F.col(f"`{key}`").alias("key")).distinct().join(
        shards, (F.col("key") <= F.col("last_key")) & (F.col("first_key").isNull() | (F.col("key") >= F.col("first_key")))
    )
    schema = T.StructType([T.StructField("key", files.key_type), T.StructField("ids", T.ArrayType(T.LongType()))])
    folder, dtype = files.folder, files.dtype

    def read(batches):
        for batch in batches:
            names = np.array(batch.column(0).to_pylist(), object)
            for name in dict.fromkeys(names):
                shard, keys = Shard(folder, name, dtype), batch.column(1).filter(pa.array(names == name)).to_pylist()
                first, count = shard.find(keys)
                documents = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count)])
                ids = [one.tolist() for one in shard.payloads(documents)]
                yield pa.RecordBatch.from_pydict({
                    "key": shard.table["key"].combine_chunks().take(pa.array(documents)),
                    "ids": pa.array(ids, pa.list_(pa.int64())),
                })

    return routed.select("name", "key").repartition("name").sortWithinPartitions("name").mapInArrow(read, schema)
