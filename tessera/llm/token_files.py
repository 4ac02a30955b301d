"""Token-ID output: files of patched frame-of-reference blocks.

1. order: texts, long ones in pieces of about ``PIECE_CHARS`` cut at spaces, are range-partitioned and sorted by document id, so partition after
   partition holds the documents end to end and a document of any length may reach over many of them;
2. write: a task encodes its pieces, closes each document with the end id, and cuts the ids into segments of ``SEGMENT_IDS``, which Spark's text writer
   puts into files of ``FILE_SEGMENTS``. A segment is a header (partition, number, sizes), a table of its documents, the index of its blocks
   (byte offset, minimum, width, number of exceptions) and the blocks of ``BLOCK`` ids: ids minus the block's minimum, packed at the width that
   holds the ``PERCENTILE`` lowest of them, then places and values of those that need more bits;
3. read: Spark's binary reader hands each file to a task, which decodes its segments; documents that reach over segments are put
   together from their parts. ``ids_between`` decodes any range of a segment through the index, touching only its blocks.

Words between spaces and line feeds are encoded once per worker and kept in a dictionary of bounded size (``by_word``): exact for tokenizers that drop white space and
never join characters across it, as ``word_bpe_49k.json`` does (a test holds it against whole texts). For others pass
``by_word=False``: whole texts then go to the library.

Edge cases: null and empty texts are the end id alone; null document ids come last; rows with equal ids follow each other by the hash of their
text; repeated rows are kept; a stretch without a space is never cut; an empty table gives files without segments and an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.llm.common import checked_broadcast, prepare_workers, stash

PIECE_CHARS = 1 << 16
#: Bytes of text that one task encodes.
TASK_BYTES = 24 << 20
SEGMENT_IDS = 1 << 22
FILE_SEGMENTS = 4
BLOCK = 1024
PERCENTILE = 0.98
MAGIC = b"TPFR"
_HEADER = struct.Struct("<4sIIIIIQ")  # magic, partition, segment, ids, blocks, documents, bytes of the segment
_DOC = np.dtype([("id", "<i8"), ("row", "<i8"), ("at", "<u4"), ("flags", "u1")])
_INDEX = np.dtype([("offset", "<u4"), ("least", "<u4"), ("exceptions", "<u2"), ("width", "u1")])
_HAS_ID, _BEGINS, _ENDS = 1, 2, 4
_MAX_WORDS, _MAX_CHARS = 5 << 17, 48
_CLOSING = ".,;:!?&%#$*)"
#: Letters below this code point may go to the model without the steps before it.
_LATIN = 0x250
_MAX_FILES = 100_000
PARTS = "part int, segment int, at long, id long, row long, whole boolean, n long, crc long"


# ---------------------------------------------------------------- blocks

def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of values below 2 ** width as rows of bytes."""
    size = 2 if width <= 16 else 4
    bits = np.unpackbits(values.astype(f"<u{size}").view(np.uint8).reshape(*values.shape, size), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), -1), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, count: int, width: int) -> np.ndarray:
    size = 2 if width <= 16 else 4
    bits = np.zeros((len(packed), count, 8 * size), np.uint8)
    bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little", count=count * width).reshape(len(packed), count, width)
    return np.packbits(bits.reshape(len(packed), -1), axis=1, bitorder="little").view(f"<u{size}").astype(np.uint32)


def pack_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """(block index, payload) of a row of 32-bit ids."""
    n = -(-len(ids) // BLOCK)
    padded = np.concatenate((ids, np.full(n * BLOCK - len(ids), ids[-1] if n else 0, np.uint32))).reshape(n, BLOCK)
    index, payload = np.zeros(n, _INDEX), [b""] * n
    index["least"] = padded.min(axis=1) if n else 0
    rest = padded - index["least"][:, None].astype(np.uint32)
    common = np.partition(rest, int(PERCENTILE * BLOCK) - 1, axis=1)[:, int(PERCENTILE * BLOCK) - 1] if n else np.zeros(0)
    index["width"] = np.ceil(np.log2(common.astype(np.float64) + 1)).astype(np.uint8)
    limit = np.uint64(1) << index["width"].astype(np.uint64)
    over = rest >= limit[:, None]
    index["exceptions"] = over.sum(axis=1)
    low = np.where(over, 0, rest)
    for width in np.unique(index["width"]).tolist():
        rows = np.flatnonzero(index["width"] == width)
        for some in np.array_split(rows, -(-len(rows) // 64)):
            for row, packed in zip(some.tolist(), _pack(low[some], width)):
                places = np.flatnonzero(over[row])
                payload[row] = packed.tobytes() + places.astype("<u2").tobytes() + rest[row, places].astype("<u4").tobytes()
    index["offset"] = np.cumsum([0, *map(len, payload)])[:n]
    return index, b"".join(payload)


def unpack_blocks(index: np.ndarray, payload: memoryview, first: int, last: int, n_ids: int) -> np.ndarray:
    """The ids of blocks ``first`` to ``last`` - 1; ``n_ids`` is the length of the whole row."""
    out = np.zeros((last - first, BLOCK), np.uint32)
    some = index[first:last]
    raw = np.frombuffer(payload, np.uint8)
    for width in np.unique(some["width"]).tolist():
        rows, size = np.flatnonzero(some["width"] == width), BLOCK * width // 8
        for part in np.array_split(rows, -(-len(rows) // 64)):
            packed = raw[some["offset"][part].astype(np.int64)[:, None] + np.arange(size)]
            out[part] = _unpack(packed, BLOCK, width)
    for row in np.flatnonzero(some["exceptions"]).tolist():
        k, at = int(some["exceptions"][row]), int(some["offset"][row]) + BLOCK * int(some["width"][row]) // 8
        out[row, np.frombuffer(payload, "<u2", k, at)] = np.frombuffer(payload, "<u4", k, at + 2 * k)
    out += some["least"][:, None]
    return out.ravel()[:n_ids - first * BLOCK]


# ---------------------------------------------------------------- segments

def write_segment(part: int, number: int, ids: np.ndarray, docs: np.ndarray) -> bytes:
    index, payload = pack_blocks(ids)
    size = _HEADER.size + docs.nbytes + index.nbytes + len(payload)
    return _HEADER.pack(MAGIC, part, number, len(ids), len(index), len(docs), size) + docs.tobytes() + index.tobytes() + payload


class Segment:
    """A segment of a file, from ``at`` on; ids are decoded on demand."""

    def __init__(self, content: bytes, at: int = 0):
        magic, self.part, self.number, self.n_ids, n_blocks, n_docs, self.size = _HEADER.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        docs = at + _HEADER.size
        blocks = docs + n_docs * _DOC.itemsize
        self.docs = np.frombuffer(content, _DOC, n_docs, docs)
        self.index = np.frombuffer(content, _INDEX, n_blocks, blocks)
        self.payload = memoryview(content)[blocks + n_blocks * _INDEX.itemsize:at + self.size]

    def ids_between(self, first: int, last: int) -> np.ndarray:
        """The ids at places ``first`` to ``last`` - 1."""
        if first >= last:
            return np.zeros(0, np.uint32)
        block = first // BLOCK
        return unpack_blocks(self.index, self.payload, block, -(-last // BLOCK), self.n_ids)[first - block * BLOCK:last - block * BLOCK]


def segments(content: bytes) -> Iterator[Segment]:
    at = 0
    while at < len(content):
        segment = Segment(content, at)
        yield segment
        at += segment.size + 1  # the text writer's line feed


# ---------------------------------------------------------------- encoding

_LOADED: dict = {}


def _word_ids(described: str) -> "WordIds":
    """One tokenizer and dictionary for all tasks of a worker."""
    from tokenizers import Tokenizer

    key = hash(described)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordIds(Tokenizer.from_str(described))
    return _LOADED[key]


class WordIds(dict):
    """Word to its ids as bytes, put together from plain words, which are encoded once.

    Punctuation behind a letter begins a token, and ASCII letters are lower-cased by the tokenizer, so ``Word,`` is ``word`` and ``,``. A full
    dictionary becomes the old one, from which words in use return; the one before it is forgotten. Long words are never kept."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = plain_letters(tokenizer)
        self.of_letters = re.compile("[" + "".join(map(chr, self.letters)) + "]+" if self.letters else "(?!)").fullmatch
        self.old: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            plain, closing = _plain(word)
            if plain != word:
                ids = self[plain] + (self[closing] if closing else b"")
            else:
                if self.of_letters(word):
                    found = [token.id for token in self.model.tokenize(word.translate(self.letters))]
                else:
                    found = self.tokenizer.encode(word, add_special_tokens=False).ids
                ids = struct.pack(f"<{len(found)}I", *found)
        if len(word) <= _MAX_CHARS:
            if len(self) >= _MAX_WORDS:
                self.old = self.copy()
                self.clear()
            self[word] = ids
        return ids


def plain_letters(tokenizer) -> dict[int, str]:
    """Latin letters to what the tokenizer hands to its model for them, where any run of them stays one piece; empty where they do not, or
    where a special token is made of letters."""
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None or any(t.content.isalpha() for t in tokenizer.get_added_tokens_decoder().values()):
        return {}
    pieces = lambda text: [piece for piece, _ in tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(text))]
    letters = [c for c in map(chr, range(_LATIN)) if c.isalpha() and len(tokenizer.normalizer.normalize_str(c)) == 1 and len(pieces(c)) == 1]
    found = {ord(c): pieces(c)[0] for c in letters}
    for run in ("".join(letters), "".join(reversed(letters))):
        if pieces(run) != [run.translate(found)]:
            return {}
    return found


def _plain(word: str) -> tuple[str, str]:
    """A word in lower case without its closing punctuation, and that; a letter that the tokenizer turns into a letter and a mark keeps it."""
    core = word.rstrip(_CLOSING)
    if len(core) < len(word) and (not core or not unicodedata.normalize("NFC", core[-1]).lower()[-1].isalpha()):
        core = word
    return core.lower() if core.isascii() and core.isalpha() else core, word[len(core):]


def encode_text(text: str, words: WordIds, by_word: bool = True) -> np.ndarray:
    """The ids of a text."""
    if not by_word:
        return np.array(words.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    return np.frombuffer(b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))), "<u4")


# ---------------------------------------------------------------- files

def text_pieces(docs: DataFrame, piece_chars: int, id_col: str, text_col: str) -> DataFrame:
    """id, text_hash, row, piece, last, text: every text in pieces that end behind a space or line feed."""
    text = F.coalesce(docs[text_col], F.lit(""))
    border = r"(?:[ \n]|\z)"
    cut = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{piece_chars}}}{border}|.+?{border}"), F.lit(0))
    pieces = F.when(F.char_length(text) > piece_chars, cut).otherwise(F.array(text))
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), F.monotonically_increasing_id().alias("row"), pieces.alias("pieces"))
    rows = rows.select("id", "text_hash", "row", F.size("pieces").alias("n"), F.posexplode("pieces").alias("piece", "text"))
    return rows.select("id", "text_hash", "row", "piece", (F.col("piece") == F.col("n") - 1).alias("last"), "text")


def _encode(batches: Iterator[pa.RecordBatch], described, end_id: int, by_word: bool, segment_ids: int) -> Iterator[pa.RecordBatch]:
    """The sorted pieces of a partition as segments."""
    from pyspark import TaskContext

    words, end = _word_ids(described.value), np.array([end_id], np.uint32)
    task = TaskContext.get()
    part, number = (task.partitionId() if task else 0), 0
    ids: list[np.ndarray] = []
    docs: list[tuple] = []
    size = 0

    def segment() -> pa.RecordBatch:
        packed = write_segment(part, number, np.concatenate(ids), np.array(docs, _DOC))
        return pa.RecordBatch.from_arrays([pa.array([packed], pa.binary())], names=["segment"])

    for batch in batches:
        for doc, row, piece, last, text in zip(*(batch.column(c).to_pylist() for c in ("id", "row", "piece", "last", "text"))):
            own = encode_text(text, words, by_word)
            own = np.concatenate((own, end)) if last else own
            at = 0
            while at < len(own):
                if size >= segment_ids:
                    yield segment()
                    ids, docs, size, number = [], [], 0, number + 1
                some = own[at:at + segment_ids - size]
                flags = (doc is not None) * _HAS_ID | (piece == 0 and at == 0) * _BEGINS | (last and at + len(some) == len(own)) * _ENDS
                if docs and docs[-1][1] == row:
                    docs[-1] = (*docs[-1][:3], docs[-1][3] | flags)
                else:
                    docs.append((doc or 0, row, size, flags))
                ids.append(some)
                size += len(some)
                at += len(some)
    if size:
        yield segment()


def write_files(docs: DataFrame, path: str, tokenizer: str, end_id: int, by_word: bool = True, id_col: str = "doc_id", text_col: str = "text",
                piece_chars: int = PIECE_CHARS, task_bytes: int = TASK_BYTES, segment_ids: int = SEGMENT_IDS) -> None:
    """The ids of all documents in ascending document order, in files below ``path``; ``tokenizer`` is the path of a file of the tokenizers
    library, read by the driver."""
    spark = docs.sparkSession
    prepare_workers(spark)
    with open(tokenizer, encoding="utf-8") as file:
        described = spark.sparkContext.broadcast(file.read())
    total = docs.agg(F.sum(F.octet_length(docs[text_col]).cast("long") + 1)).first()[0] or 0
    order = [F.col("id").asc_nulls_last(), F.col("text_hash"), F.col("row"), F.col("piece")]
    pieces = text_pieces(docs, piece_chars if by_word else (1 << 31) - 1, id_col, text_col)
    ordered = pieces.repartitionByRange(max(1, -(-total // task_bytes)), *order).sortWithinPartitions(*order)
    cut = ordered.select("id", "row", "piece", "last", "text").mapInArrow(lambda batches: _encode(batches, described, end_id, by_word, segment_ids), "segment binary")
    cut.select(F.col("segment").cast("string").alias("value")).write.option("maxRecordsPerFile", FILE_SEGMENTS).text(path)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            for s in segments(content.as_py()):
                ids, docs = s.ids_between(0, s.n_ids), s.docs
                ends = np.append(docs["at"][1:], s.n_ids).astype(np.int64)
                raw = memoryview(ids.astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * i:4 * j]) for i, j in zip(docs["at"].tolist(), ends.tolist())]
                flags = docs["flags"]
                numbers = [np.full(len(docs), s.part, np.int32), np.full(len(docs), s.number, np.int32), docs["at"].astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [*map(pa.array, numbers), pa.array(docs["id"].astype(np.int64), mask=flags & _HAS_ID == 0), pa.array(docs["row"].astype(np.int64)),
                     pa.array(flags & (_BEGINS | _ENDS) == _BEGINS | _ENDS), pa.array(ends - docs["at"]), pa.array(crc, pa.int64())],
                    names=["part", "segment", "at", "id", "row", "whole", "n", "crc"])


_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, reflected


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32; the highest bit is the power 0."""
    product = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            product ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return product


def joined_crc(first: int, second: int, n_bytes: int) -> int:
    """CRC-32 of two strings end to end from theirs; ``n_bytes`` is the length of the second."""
    shift, square = 1 << 31, 1 << 23  # the powers 0 and 8 (one byte)
    while n_bytes:
        if n_bytes & 1:
            shift = _times(square, shift)
        square, n_bytes = _times(square, square), n_bytes >> 1
    return _times(shift, first) ^ second


def _join(frame: pd.DataFrame) -> pd.DataFrame:
    parts = frame.sort_values("start")
    crc = 0
    for n, c in zip(parts["n"].tolist(), parts["crc"].tolist()):
        crc = joined_crc(crc, c, 4 * n)
    return pd.DataFrame({"id": parts["id"].iloc[:1], "start": parts["start"].iloc[:1], "n": [parts["n"].sum()], "crc": [crc]})


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """id, start (ids of all documents before), n_tokens and ids_crc32 (of the ids as little-endian 32-bit numbers) of every document in the files."""
    prepare_workers(spark)
    contents = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    parts = stash(contents.mapInArrow(_parts, PARTS), "token-parts")
    sizes = parts.groupBy("part", "segment").agg(F.sum("n").alias("size"))
    files = sizes.groupBy("part").agg(F.sum("size").alias("of_file"))  # one row a file
    before_file = files.select("part", (F.sum("of_file").over(Window.orderBy("part")) - F.col("of_file")).alias("before_file"))
    before = F.sum("size").over(Window.partitionBy("part").orderBy("segment")) - F.col("size")
    places = sizes.withColumn("before", before).join(before_file, "part").select("part", "segment", (F.col("before") + F.col("before_file")).alias("first"))
    placed = parts.join(checked_broadcast(places, _MAX_FILES), ["part", "segment"]).withColumn("start", F.col("first") + F.col("at"))
    whole = placed.where("whole").select("id", "start", "n", "crc")
    cut = placed.where("not whole").groupBy("row").applyInPandas(_join, "id long, start long, n long, crc long")
    return whole.unionByName(cut).select("id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32"))
