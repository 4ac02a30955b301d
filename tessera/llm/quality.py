"""Quality rules with cross-document line frequency.

One pass over the texts gives each document's counts and the hash and word count of each of
its normalised lines (words lower-cased A-Z, joined by one space). (host, hash, document)
rows are made distinct - the document in the key spreads a line that every document holds -
and counted per host with map-side combining. Lines held by more documents of a host than
max(min_docs, share of the host's documents) are removed; a document is rejected
when its base rules fail or when less than ``min_left`` of its words is left.

Counts: words are runs of non-whitespace; a word is a repeat when any 3-word window covering it
is found twice or more in the text. Edge cases: a null or empty text has no words and fails the base
rules; lines without a word are never counted or removed; a null host is a host; rows with the
same id count as one document on both sides of line frequency (lines and hosts) but are judged row by row; an empty table
gives an empty result; texts of any length are judged whole, one at a time in a task; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers, stash, text_bytes

WHITESPACE_BYTES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LINE_MIN_DOCS = 20
LINE_SHARE = 0.01
MIN_LEFT = 0.5
WINDOW = 3

STATS = ("id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
         "line_hashes array<long>, line_words array<int>")


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words covered by windows of ``width`` words that occur twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    vocabulary: dict[bytes, int] = {}
    ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words))
    size = bound = len(vocabulary)
    keys = ids[:n].copy()
    for k in range(1, width):
        if bound > (1 << 62) // size:  # the next product would leave 64 bits: rank what there is so far
            keys, bound = np.unique(keys, return_inverse=True)[1], n
        keys, bound = keys * size + ids[k:n + k], bound * size
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    found = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
    covered = np.zeros(len(words), bool)
    for k in range(width):
        covered[k:n + k] |= found
    return int(covered.sum())


def text_stats(text: bytes) -> tuple[int, int, int, int, int, list[int], list[int]]:
    lines = [line for line in text.split(b"\n") if line.strip()]
    split = [line.split() for line in lines]
    words = [w for line in split for w in line]
    chars = len(text.decode("utf-8", "replace")) - sum(text.count(c) for c in WHITESPACE_BYTES)
    hashes = [xxhash.xxh64_intdigest(b" ".join(line).lower()) - (1 << 63) for line in split]
    return (len(words), chars, sum(text.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words),
            hashes, [len(line) for line in split])


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [text_stats(t or b"") for t in batch.column("text").to_pylist()]
        columns = [list(c) for c in zip(*rows)] or [[] for _ in range(7)]
        arrays = [pa.array(c, pa.int64()) for c in columns[:5]]
        arrays += [pa.array(columns[5], pa.list_(pa.int64())), pa.array(columns[6], pa.list_(pa.int32()))]
        names = ["id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_hashes", "line_words"]
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("host"), *arrays], names=names)


def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Counts and line hashes of every document, written once; rid numbers the rows."""
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), docs[host_col].cast("string").alias("host"), text_bytes(docs[text_col]).alias("text"))
    return stash(rows.mapInArrow(_stats, STATS).withColumn("rid", F.monotonically_increasing_id()), "quality-stats")


def frequent_lines(stats: DataFrame, min_docs: int = LINE_MIN_DOCS, share: float = LINE_SHARE) -> DataFrame:
    """(host, h, n_docs) of lines in more documents of their host than the limit."""
    lines = stats.select("host", "id", F.explode(F.array_distinct("line_hashes")).alias("h"))
    n_docs = lines.groupBy("host", "h", "id").agg(F.lit(1).alias("one")).groupBy("host", "h").agg(F.count("*").alias("n_docs"))
    hosts = stats.select("host", "id").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    limit = F.greatest(F.lit(float(min_docs)), F.col("host_docs") * share)
    frequent = n_docs.where(F.col("n_docs") > min_docs).withColumnRenamed("host", "line_host")
    return frequent.join(hosts, F.col("line_host").eqNullSafe(F.col("host"))).where(F.col("n_docs") > limit).select("host", "h", "n_docs")


def judge_documents(stats: DataFrame, min_docs: int = LINE_MIN_DOCS, share: float = LINE_SHARE, min_left: float = MIN_LEFT) -> DataFrame:
    """stats with removed_lines (positions among lines with a word), n_removed_words, base_failed and kept."""
    # written, so that the join reads plain shuffles and Spark can split the partition of a line that very many documents hold
    frequent = stash(frequent_lines(stats, min_docs, share).select(F.col("host").alias("f_host"), F.col("h").alias("f_h")), "frequent-lines")
    lines = stats.select("rid", "host", "line_words", F.posexplode("line_hashes").alias("pos", "h"))
    lines = lines.select("rid", "host", "pos", "h", F.element_at("line_words", F.col("pos") + 1).alias("words"))
    removed = lines.join(frequent, (F.col("h") == F.col("f_h")) & F.col("host").eqNullSafe(F.col("f_host"))).groupBy("rid").agg(
        F.sum("words").alias("removed_words"), F.sort_array(F.collect_list("pos")).alias("removed_lines"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = stats.drop("line_hashes", "line_words").join(removed, "rid", "left").withColumn("base_failed", base)
    judged = judged.withColumn("n_removed_words", F.coalesce("removed_words", F.lit(0)).cast("long"))
    depleted = F.col("n_words") - F.col("n_removed_words") < min_left * F.col("n_words")
    return judged.withColumn("kept", ~base & ~depleted).drop("removed_words")


def without_lines(text: bytes, removed: list[int]) -> bytes:
    """The text without the lines at these positions among its lines with a word."""
    gone, out, k = set(removed), [], 0
    for line in text.split(b"\n"):
        worded = bool(line.strip())
        if not (worded and k in gone):
            out.append(line)
        k += worded
    return b"\n".join(out)
