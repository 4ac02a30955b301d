"""Line dedup with DataFrame functions only.

Each line becomes a 96-bit hash of its key (the line stripped of whitespace, A-Z
lower-cased). The narrow rows (hash, document, position) are combined per hash and
salt first, so a line that a third of all documents share arrives as a few rows;
these are range-partitioned by hash with a secondary sort by document and position,
and a streaming window keeps the first occurrence of each hash. The result is a run-length
compressed keep bitmap per document; texts are only touched when bitmaps are applied.

Edge cases: a null or empty text is one empty line; keys under ``min_key_chars`` code
points are never dropped; rows with the same id count as one document, a null id as one
document behind all others; texts and lines of any length are split and hashed whole; repeated rows get equal bitmaps; an empty table gives an
empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import WHITESPACE, lower_az, null_last, stash

SALTS = 8


def text_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return lower_az(F.btrim(line, F.lit(WHITESPACE)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(docs[id_col].alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))


def line_occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 10) -> DataFrame:
    """(h, h2, id, text_hash, n_lines, pos) of every line whose key is long enough."""
    rows = _rows(docs, id_col, text_col).select("id", "text_hash", text_lines(F.col("text")).alias("lines"))
    keys = rows.select("id", "text_hash", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    keys = keys.select("id", "text_hash", "n_lines", "pos", line_key(F.col("line")).alias("k"))
    return keys.where(F.char_length("k") >= min_key_chars).select(
        F.xxhash64("k").alias("h"), F.hash("k").alias("h2"), "id", "text_hash", "n_lines", "pos")


def first_occurrences(occ: DataFrame) -> DataFrame:
    """(h, h2, owner) of every key found in two documents or more; owner is the
    smallest document as a struct (absent, id)."""
    doc = null_last(F.col("id"))
    salted = occ.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)))
    combined = salted.groupBy("h", "h2", "salt").agg(
        F.min(F.struct(doc.alias("doc"), F.col("pos").alias("pos"))).alias("first"), F.max(doc).alias("last"))
    ranged = combined.repartitionByRange("h", "h2").sortWithinPartitions("h", "h2", "first")
    same = Window.partitionBy("h", "h2")
    stream = ranged.select(
        "h", "h2", F.col("first.doc").alias("owner"),
        F.row_number().over(same.orderBy("first")).alias("nth"),
        F.max("last").over(same).alias("last_doc"))
    return stream.where((F.col("nth") == 1) & ~F.col("owner").eqNullSafe(F.col("last_doc"))).select("h", "h2", "owner")


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 10) -> DataFrame:
    """One row for each document that loses lines: id, text_hash, n_lines,
    n_dropped, keep_runs (array of (start, length) of kept lines)."""
    occ = stash(line_occurrences(docs, id_col, text_col, min_key_chars), "line-occurrences")
    owners = first_occurrences(occ).withColumn("salt", F.explode(F.array(*[F.lit(i).cast("long") for i in range(SALTS)])))
    hits = occ.withColumn("salt", F.pmod(F.xxhash64("id", "text_hash"), F.lit(SALTS)).cast("long")).join(owners, ["h", "h2", "salt"])
    dropped = hits.where(~null_last(F.col("id")).eqNullSafe(F.col("owner")))
    per_doc = dropped.groupBy("id", "text_hash", "n_lines").agg(F.sort_array(F.collect_set("pos")).alias("gone"))
    runs = F.filter(
        F.zip_with(
            F.concat(F.array(F.lit(-1)), "gone"), F.concat("gone", F.array("n_lines")),
            lambda a, b: F.struct((a + 1).alias("start"), (b - a - 1).alias("length"))),
        lambda r: r["length"] > 0)
    return per_doc.select("id", "text_hash", "n_lines", F.size("gone").alias("n_dropped"), runs.alias("keep_runs"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, n_lines, n_dropped, kept_text) for every input row; row is a struct of
    all columns but the text."""
    text = F.coalesce(docs[text_col], F.lit(""))
    others = F.struct(*[docs[f"`{c}`"] for c in docs.columns if c != text_col])
    rows = docs.select(others.alias("row"), docs[id_col].alias("id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    maps = bitmaps.select(
        F.col("id").alias("map_id"), F.col("text_hash").alias("map_hash"), F.col("n_dropped").alias("map_dropped"), "keep_runs")
    joined = rows.join(
        maps.hint("shuffle_hash"),
        F.col("text_hash").eqNullSafe(F.col("map_hash")) & F.col("id").eqNullSafe(F.col("map_id")), "left")
    lines = text_lines(F.col("text"))
    kept = F.array_join(F.flatten(F.transform("keep_runs", lambda r: F.slice(F.col("lines"), r["start"] + 1, r["length"]))), "\n")
    return joined.withColumn("lines", lines).select(
        "row", "id", F.size("lines").cast("long").alias("n_lines"),
        F.coalesce("map_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep_runs").isNull(), F.col("text")).otherwise(kept).alias("kept_text"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_key_chars: int = 10) -> DataFrame:
    """``docs`` with the text reduced to its kept lines; same columns and rows."""
    kept = apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_key_chars), id_col, text_col)
    return kept.select(*[F.col("kept_text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
