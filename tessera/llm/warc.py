"""WARC archives: writing, and reading back with boundary-chain verification.

Writing: one record per row through Spark's text writer, whose line separator is the blank line pair that ends a
record; every part file is a valid archive. Of rows with equal payloads the one with the largest id is the
response, the others are revisits of it.

Reading: the text reader splits archives at the magic ``WARC/1.1``, wherever it stands, so each split is read once and
no file is held whole. A task turns every piece into a candidate: its offset, and the offset of its successor by
header and Content-Length. Magic inside a payload makes false candidates, so only those on the chain that starts at
the file's first byte count. Inside a split a task shortens each candidate's chain to the point where it leaves
the split; across splits pointer jumping (links doubled each round, joins of a few rows per split) finds the
point where the chain enters each split. A payload that contains magic is put together again from its pieces.

Edge cases: a null payload is empty; a null id is kept as null (all-null groups are responses); rows that repeat the largest
id of a group are all responses; line breaks in a URL are percent-encoded, a null URL has no header; a file cut short keeps
the records before the cut; payloads of any length are written whole, read by split and joined per record; an empty table writes and reads no record; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tessera.llm.common import prepare_workers, checked_broadcast, stash

MAGIC = "WARC/1.1\r\n"
BLANK = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Groups of equal payloads up to this many are broadcast, more are joined by shuffle.
MAX_BROADCAST_GROUPS = 100_000
_BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PIECES = ("file string, block long, nth long, length long, head_length long, content_length long, record_type string, id long, url string, "
          "refers_to long, stated_digest string, stated_bytes long, digest string")


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: four groups of 40 bits, eight digits each."""
    digest = F.sha1(payload.cast("binary"))
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*groups)), _BASE32_DIGITS, _BASE32_LETTERS)


def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_revisit_bytes: int) -> DataFrame:
    rows = pages.select(pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"), F.coalesce(pages[payload_col].cast("string"), F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload"))).withColumn("n_bytes", F.octet_length("payload"))
    groups = rows.where(F.col("n_bytes") >= min_revisit_bytes).groupBy(F.col("digest").alias("g_digest"), F.col("n_bytes").alias("g_bytes")).agg(
        F.max("id").alias("response_id"), F.count("*").alias("n"))
    groups = checked_broadcast(groups.where("n > 1"), MAX_BROADCAST_GROUPS)
    rows = rows.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("n_bytes") == F.col("g_bytes")), "left")
    return rows.withColumn("revisit", F.col("n").isNotNull() & ~F.col("id").eqNullSafe(F.col("response_id")))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0) -> None:
    rows = _records(pages, id_col, url_col, payload_col, min_revisit_bytes)

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    def page(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))

    revisit = F.col("revisit")
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    none = F.lit("")
    record = F.concat(
        F.lit(MAGIC), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", page(F.col("id"))),
        line("WARC-Date", F.lit(DATE)), F.coalesce(line("WARC-Target-URI", url), none),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")), line("X-Payload-Length", F.col("n_bytes").cast("string")),
        F.when(revisit, F.concat(line("WARC-Refers-To", page(F.col("response_id"))), line("WARC-Profile", F.lit(PROFILE)))).otherwise(none),
        line("Content-Type", F.lit("text/html")), line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("n_bytes").cast("string"))),
        F.lit("\r\n"), F.when(revisit, none).otherwise(F.col("payload")))
    rows.select(record.alias("value")).write.option("lineSep", BLANK).text(path)


def _header(head: bytes, name: bytes, pattern: bytes) -> bytes | None:
    found = re.search(rb"(?im)^" + name + rb":[ \t]*" + pattern + rb"[ \t]*\r?$", head)
    return found.group(1) if found else None


def _number(raw: bytes | None) -> int | None:
    return int(raw) if raw else None


def _text(raw: bytes | None) -> str | None:
    return raw.decode("utf-8", "replace") if raw is not None else None


def _base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def describe_piece(value: bytes) -> tuple:
    """Lengths and header fields of the text between two magics; the digest only if the piece is a whole record."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return (len(value), None, None, None, None, None, None, None, None, None)
    head, start = value[:end], end + 4
    n = _number(_header(head, rb"Content-Length", rb"([0-9]{1,18})"))
    whole = n is not None and len(value) == start + n + len(BLANK)
    return (len(value), start, n, _text(_header(head, rb"WARC-Type", rb"([a-z]+)")), _number(_header(head, rb"WARC-Record-ID", rb"<urn:page:(-?[0-9]+)>")),
            _text(_header(head, rb"WARC-Target-URI", rb"([^\r\n]*?)")), _number(_header(head, rb"WARC-Refers-To", rb"<urn:page:(-?[0-9]+)>")),
            _text(_header(head, rb"WARC-Payload-Digest", rb"sha1:([A-Z2-7]+)")), _number(_header(head, rb"X-Payload-Length", rb"([0-9]{1,18})")),
            _base32(value[start:start + n]) if whole else None)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[int]]]:
    """Batches with the ordinal of every piece in its split; a task reads its splits one after another."""
    split, k = None, 0
    for batch in batches:
        nth = []
        for at in zip(batch.column("file").to_pylist(), batch.column("block").to_pylist()):
            if at != split:
                split, k = at, 0
            nth.append(k)
            k += 1
        yield batch, nth


def _pin_splits(spark: SparkSession) -> None:
    """Keeps the size of splits from following the number of executors, which may change between the two scans: pieces are matched by split."""
    number = "spark.sql.files.minPartitionNum"
    if spark.conf.get(number, None) is None:
        spark.conf.set(number, str(spark.sparkContext.defaultParallelism))


def _raw_pieces(spark: SparkSession, path: str) -> DataFrame:
    prepare_workers(spark)
    raw = spark.read.option("lineSep", MAGIC).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


def scan_pieces(spark: SparkSession, path: str) -> DataFrame:
    names = T.StructType.fromDDL(PIECES).fieldNames()
    types = [pa.int64()] * 3 + [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, nth in _numbered(batches):
            columns = list(zip(*(describe_piece(v) for v in batch.column("value").to_pylist()))) or [()] * 10
            arrays = [pa.array(list(c), t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays([batch.column("file"), batch.column("block"), pa.array(nth, pa.int64()), *arrays], names=names)

    return stash(_raw_pieces(spark, path).mapInArrow(run, PIECES), "warc-pieces")


def _chain(frame: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offset, successor, index of the successor inside the split or the number of pieces) of a split's pieces in order."""
    length = frame["length"].to_numpy(np.int64)
    start = frame["base"].iloc[0] + np.concatenate(([0], np.cumsum(length + len(MAGIC))[:-1]))
    offset = start - len(MAGIC)
    valid = (frame["content_length"].notna() & frame["head_length"].notna()).to_numpy() & (offset >= 0)
    size = len(MAGIC) + frame["head_length"].fillna(0).to_numpy(np.int64) + frame["content_length"].fillna(0).to_numpy(np.int64) + len(BLANK)
    after = np.where(valid, offset + size, -1)
    k = np.minimum(np.searchsorted(offset, after), len(offset) - 1)
    return offset, after, np.where(valid & (offset[k] == after), k, len(offset))


def _exits(frame: pd.DataFrame) -> pd.DataFrame:
    """Where the chain of every candidate leaves its split; -1: at a broken record."""
    frame = frame.sort_values("nth")
    offset, after, nxt = _chain(frame)
    n = len(offset)
    last = np.where(nxt < n, nxt, np.arange(n))
    while (last != (further := last[last])).any():
        last = further
    found = offset >= 0
    return pd.DataFrame({"file": frame["file"].iloc[0], "block": frame["block"].iloc[0], "offset": offset[found], "exit": after[last][found]})


def _reached(frame: pd.DataFrame) -> pd.DataFrame:
    """Offsets of all pieces, and which are records on the chain from the split's entry."""
    frame = frame.sort_values("nth")
    offset, after, nxt = _chain(frame)
    reached = np.zeros(len(offset), bool)
    entry, steps = frame["entry"].iloc[0], nxt.tolist()
    if not pd.isna(entry):
        k = int(np.searchsorted(offset, int(entry)))
        while k < len(steps) and after[k] >= 0:
            reached[k] = True
            k = steps[k]
    return pd.DataFrame({"file": frame["file"], "block": frame["block"], "nth": frame["nth"], "offset": offset, "after": after, "reached": reached})


def chain_entries(pieces: DataFrame, exits: DataFrame) -> DataFrame:
    """(file, block, entry): where the verified chain enters each split, by pointer jumping from offset 0."""
    files = pieces.select("file").distinct().select("file", F.lit(0).cast("long").alias("offset"))
    targets = exits.where("exit >= 0").select("file", F.col("exit").alias("offset")).unionByName(files).distinct()
    links = stash(exits.join(targets, ["file", "offset"]).select("file", F.col("offset").alias("a"), F.col("exit").alias("b")), "warc-links")
    most = pieces.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    reached = files
    for _ in range(max(0, int(most) - 1).bit_length()):
        step = links.join(reached.withColumnRenamed("offset", "a"), ["file", "a"]).select("file", F.col("b").alias("offset")).where("offset >= 0")
        reached = stash(reached.unionByName(step).distinct(), "warc-reached")
        far = links.select("file", F.col("a").alias("b"), F.col("b").alias("c"))
        links = stash(links.join(far, ["file", "b"], "left").select("file", "a", F.coalesce("c", "b").alias("b")), "warc-links")
    return reached.join(exits, ["file", "offset"]).groupBy("file", "block").agg(F.min("offset").alias("entry"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Verified records: file, offset, record_type, id, url, refers_to, payload_bytes, payload_digest (of a response
    computed from what was read; of a revisit as stated) and digest_ok."""
    _pin_splits(spark)
    pieces = scan_pieces(spark, path)
    sizes = pieces.groupBy("file", "block").agg(F.sum(F.col("length") + len(MAGIC)).alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = stash(sizes.select("file", "block", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base")), "warc-bases")
    narrow = pieces.select("file", "block", "nth", "length", "head_length", "content_length").join(bases, ["file", "block"])
    exits = stash(narrow.groupBy("file", "block").applyInPandas(_exits, "file string, block long, offset long, exit long"), "warc-exits")
    entered = narrow.join(chain_entries(pieces, exits), ["file", "block"], "left")
    chained = entered.groupBy("file", "block").applyInPandas(_reached, "file string, block long, nth long, offset long, after long, reached boolean")
    chained = stash(chained, "warc-chain")
    records = chained.where("reached").drop("reached").join(pieces, ["file", "block", "nth"])
    in_parts = records.where(F.col("digest").isNull()).select("file", "offset", "after", "head_length", "content_length")
    joined = _joined_digests(spark, path, chained, in_parts) if in_parts.limit(1).count() else None
    if joined is not None:
        records = records.join(joined, ["file", "offset"], "left").withColumn("digest", F.coalesce("digest", "joined_digest"))
    revisit = F.col("record_type") == "revisit"
    return records.select(
        "file", "offset", "record_type", "id", "url", "refers_to", F.when(revisit, F.col("stated_bytes")).otherwise(F.col("content_length")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        (revisit | (F.col("digest") == F.col("stated_digest"))).alias("digest_ok"))


def _joined_digests(spark: SparkSession, path: str, chained: DataFrame, in_parts: DataFrame) -> DataFrame:
    """(file, offset, joined_digest) of records whose payload holds magic: their pieces are read again and joined.
    The window runs over the narrow rows of one archive file."""
    upto = Window.partitionBy("file").orderBy("offset")
    marked = chained.join(in_parts.select("file", "offset", F.col("after").alias("until"), F.col("head_length").alias("skip"), "content_length"), ["file", "offset"], "left")
    owner = F.last(F.when(F.col("reached"), F.struct(F.col("offset").alias("owner"), "until", "skip", "content_length")), True).over(upto)
    owned = marked.withColumn("o", owner).where(F.col("o.until").isNotNull()).select("file", "block", "nth", "offset", "o.owner", "o.skip", "o.content_length")

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, nth in _numbered(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(nth, pa.int64()), batch.column("value")], names=["file", "block", "nth", "value"])

    texts = _raw_pieces(spark, path).mapInArrow(values, "file string, block long, nth long, value binary")

    def join(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("offset")
        first = frame.iloc[0]
        whole = MAGIC.encode().join(frame["value"].tolist())
        payload = whole[int(first["skip"]):int(first["skip"] + first["content_length"])]
        return pd.DataFrame({"file": [first["file"]], "offset": [first["owner"]], "joined_digest": [_base32(payload)]})

    return texts.join(owned, ["file", "block", "nth"]).groupBy("file", "owner").applyInPandas(join, "file string, offset long, joined_digest string")
