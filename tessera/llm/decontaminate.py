"""Benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs between whitespace and ASCII punctuation. A seed is a fixed mask over
consecutive words: the marked positions are hashed, the others ignored, so a substituted word under an
ignored position does not hide a hit. The two masks together meet every window of 13 words that has at most two
substitutions (tests check all patterns), i.e. every window with 80 percent equal words.
Items, distinct by id and text, become a Spark table of seeds; so do documents, as far as a bit filter of fixed size
that holds every seed of the benchmark lets them pass. The two meet by hash in a shuffle join, frequent seeds of
documents dealt over salts. A seed carries the words around it, as far as a window that holds the seed can reach: on a
hit's diagonal they are compared word by word, and only windows of ``WINDOW`` words with at least ``MIN_EQUAL`` equal
ones count; per document and item the windows of a diagonal that touch are then put together, one overlap each. An item of ``SHORTEST`` to 12 words is one window:
it is cut into one piece more than the substitutions that 80 percent allow, so that one piece is unchanged, and the pieces are its seeds. Shorter items
are no evidence and mark nothing.

The driver and the executors hold only the filter and the counts of seeds per slot, whose sizes are fixed; neither the
benchmark nor the documents are ever collected. A benchmark that fills the filter lets more seeds pass into the join.

Edge cases: null or empty texts and items hit nothing; texts of any length are read whole; items with the same id count as one; repeated rows
are judged alike; an empty table on either side finds nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers, stash

#: Positions that are hashed; the gaps may differ.
MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 2, 4, 7, 8))
WINDOW = 13
MIN_EQUAL = 0.8
#: Items of fewer words are too short to be evidence.
SHORTEST = 5
#: Benchmark words that a task cuts into seeds.
BLOCK_WORDS = 2_000_000
_SEPARATORS = "".join(chr(i) for i in range(128) if not chr(i).isalnum())
_TABLE = bytes(32 if chr(i) in _SEPARATORS and i < 128 else i for i in range(256))
_FILTER_BITS = 26
#: Seeds of documents are counted in 2 ** _SLOT_BITS slots of their hash; a slot of more than HOT_SEEDS is dealt over salts.
_SLOT_BITS = 16
HOT_SEEDS = 2_000
def short_pieces(n: int) -> list[tuple[int, int]]:
    """(offset, words) of the pieces of an item of ``n`` words: one more than the words that may differ."""
    pieces = n - math.ceil(MIN_EQUAL * n) + 1
    cuts = [k * n // pieces for k in range(pieces + 1)]
    return [(a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]


#: (length of the item, offset of the piece, words of the piece) of every seed of short items.
SHORT = tuple((n, *piece) for n in range(SHORTEST, WINDOW) for piece in short_pieces(n))
#: Words before and after a seed's first word that a window holding the seed can reach.
_BEFORE = max(WINDOW - 1 - min(mask[-1] for mask in MASKS), *(offset for _, offset, _ in SHORT))
_AROUND = _BEFORE + WINDOW
_ROWS = 20_000
_MAX_WORDS = 1 << 20
SEEDS = "mask int, seed long, id long, text_hash long, position int, around binary, dealt int"
GOOD = "id long, text_hash long, item_id long, item_hash long, diagonal int, block int, equal long, first int, last int"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_TABLE).split()


def _coefficients(n: int) -> np.ndarray:
    return np.random.default_rng(9).integers(1, 1 << 62, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def seed_keys(ids: np.ndarray, mask: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the mask at every place where no hashed word is 0 (not a benchmark word)."""
    n = len(ids) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    key, known = np.full(n, salt, np.uint64), np.ones(n, bool)
    for c, k in zip(_coefficients(len(mask)), mask):
        part = ids[k:k + n]
        key = (key ^ part.astype(np.uint64)) * c
        key ^= key >> np.uint64(29)
        known &= part > 0
    at = np.flatnonzero(known)
    return at, key[at]


class _Hashes(dict):
    """Word to hash, never 0; forgets everything when it grows large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MAX_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word) or 1
        return value


def _mask(m: int) -> tuple[int, ...]:
    """Masks are numbered: those of ``MASKS``, then one for each seed of ``SHORT``."""
    return MASKS[m] if m < len(MASKS) else tuple(range(SHORT[m - len(MASKS)][2]))


def _seeds(batches: Iterator[pa.RecordBatch], masks: list[int], bits: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Seeds of items (without ``bits``: each item by the masks of its length), or seeds of documents that pass the filter ``bits``."""
    hashes, gap, dealt = _Hashes(), np.zeros(_AROUND, np.uint64), 0
    for batch in batches:
        parts, lengths = [gap], []
        for text in batch.column("text").to_pylist():
            own = words_of(text or "")
            parts += [np.fromiter(map(hashes.__getitem__, own), np.uint64, len(own)), gap]
            lengths.append(len(own))
        lengths = np.array(lengths, np.int64)
        starts = len(gap) + np.cumsum(lengths + len(gap)) - lengths - len(gap)
        words = np.concatenate(parts)
        for m in masks:
            at, key = seed_keys(words, _mask(m), m)
            if bits is not None:
                slot = key >> np.uint64(64 - _FILTER_BITS)
                passed = bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1) > 0
                at, key = at[passed], key[passed]
            row = np.searchsorted(starts, at, "right") - 1
            if bits is None:
                n, offset, _ = SHORT[m - len(MASKS)] if m >= len(MASKS) else (0, 0, 0)
                fits = (lengths[row] == n) & (at == starts[row] + offset) if n else lengths[row] >= WINDOW
                at, key, row = at[fits], key[fits], row[fits]
            for k in range(0, len(at), _ROWS):
                a, r = at[k:k + _ROWS], row[k:k + _ROWS]
                around = words[a[:, None] + np.arange(-_BEFORE, WINDOW)].astype("<u8")
                ends = pa.py_buffer((np.arange(len(a) + 1) * 8 * _AROUND).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(a), m, np.int32)), pa.array(key[k:k + _ROWS].view(np.int64)), batch.column("id").take(pa.array(r)), batch.column("text_hash").take(pa.array(r)),
                    pa.array((a - starts[r]).astype(np.int32)), pa.Array.from_buffers(pa.binary(), len(a), [None, ends, pa.py_buffer(around.tobytes())]),
                    pa.array(((dealt + np.arange(len(a))) % (1 << 31)).astype(np.int32))], names=["mask", "seed", "id", "text_hash", "position", "around", "dealt"])
                dealt += len(a)


_WIDTHS = np.array([WINDOW] * len(MASKS) + [n for n, _, _ in SHORT])
_OFFSETS = np.array([0] * len(MASKS) + [offset for _, offset, _ in SHORT])


def _words_around(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, _AROUND)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The good windows around every hit: their equal words as bits of 64-word blocks of the document, first word and end."""
    for batch in batches:
        doc, item = _words_around(batch.column("around")), _words_around(batch.column("item_around"))
        mask, position, offset = (batch.column(c).to_numpy().astype(np.int64) for c in ("mask", "position", "item_position"))
        inside = (doc > 0) & (item > 0)
        equal = inside & (doc == item)
        good = np.zeros((len(doc), _BEFORE + 1), bool)
        width = _WIDTHS[mask]
        for n in np.unique(width).tolist():
            rows = width == n
            for k in range(_BEFORE + 1) if n == WINDOW else {_BEFORE - o for m, o, _ in SHORT if m == n}:
                window, starts = slice(k, k + n), rows if n == WINDOW else rows & (_OFFSETS[mask] == _BEFORE - k)
                good[:, k] |= starts & inside[:, window].all(axis=1) & (equal[:, window].sum(axis=1) >= MIN_EQUAL * n)
        covered = np.zeros(equal.shape, bool)
        for k in range(_BEFORE + 1):
            covered |= good[:, k, None] & (np.arange(_AROUND) >= k) & (np.arange(_AROUND) < k + width[:, None])
        base = position - _BEFORE
        first, last = base + good.argmax(axis=1), base + _BEFORE - good[:, ::-1].argmax(axis=1) + width
        bits = ((equal & covered) << np.arange(_AROUND, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        shift = (base & 63).astype(np.uint64)
        low, high = bits << shift, (bits >> np.uint64(1)) >> (np.uint64(63) - shift)
        for rows, block, part in ((np.flatnonzero(good.any(axis=1)), base >> 6, low), (np.flatnonzero(high), (base >> 6) + 1, high)):
            columns = [batch.column(c).take(pa.array(rows)) for c in ("id", "text_hash", "item_id", "item_hash")]
            numbers = [pa.array(x[rows].astype(np.int32)) for x in (position - offset, block)]
            ends = [pa.array(x[rows].astype(np.int32)) for x in (first, last)]
            yield pa.RecordBatch.from_arrays([*columns, *numbers, pa.array(part[rows].view(np.int64)), *ends],
                                             names=["id", "text_hash", "item_id", "item_hash", "diagonal", "block", "equal", "first", "last"])


def benchmark_seeds(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> DataFrame:
    """The seeds of all items; items are distinct by id and text."""
    items = benchmark.select(benchmark[id_col].cast("long").alias("id"), benchmark[text_col].alias("text")).where("text is not null").distinct()
    items = stash(items.select("id", F.xxhash64("text").alias("text_hash"), "text"), "benchmark-items")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    dealt = items.repartition(max(1, -(-size // (5 * block_words))), "id", "text_hash")
    masks = list(range(len(MASKS) + len(SHORT)))
    return stash(dealt.mapInArrow(lambda batches: _seeds(batches, masks, None), SEEDS), "benchmark-seeds")


def seed_filter(seeds: DataFrame) -> tuple[np.ndarray, list[int]]:
    """2 ** _FILTER_BITS bits, set for every seed, and the masks in use."""
    slots = seeds.select("mask", F.shiftrightunsigned("seed", 64 - _FILTER_BITS).alias("slot"))
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("bits"), F.expr("bit_or(shiftleft(1, mask))").alias("masks")).toPandas()
    bits = np.zeros(1 << (_FILTER_BITS - 6), np.uint64)
    bits[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    used = int(np.bitwise_or.reduce(words["masks"].to_numpy(np.int64), initial=0))
    return bits, [m for m in range(used.bit_length()) if used >> m & 1]


def _join(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Seeds of documents with equal seeds of items; slots with many seeds of documents are dealt over salts."""
    slot = F.shiftrightunsigned("seed", 64 - _SLOT_BITS)
    limit = max(HOT_SEEDS, 4 * docs.count() >> _SLOT_BITS)
    hot = docs.groupBy(slot.alias("slot")).count().where(F.col("count") > limit).select("slot", F.ceil(F.col("count") / limit).cast("int").alias("salts"))
    hot = F.broadcast(docs.sparkSession.createDataFrame([tuple(r) for r in hot.collect()], "slot long, salts int"))  # at most 2 ** _SLOT_BITS / 4 rows
    salts = F.coalesce("salts", F.lit(1))
    docs = docs.withColumn("slot", slot).join(hot, "slot", "left").withColumn("salt", F.pmod("dealt", salts))
    items = items.withColumn("slot", slot).join(hot, "slot", "left").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    items = items.select("mask", "seed", "salt", F.col("id").alias("item_id"), F.col("text_hash").alias("item_hash"), F.col("position").alias("item_position"), F.col("around").alias("item_around"))
    return docs.drop("slot", "salts", "dealt").join(items.hint("merge"), ["seed", "mask", "salt"])


def find_overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per verified overlap: id, text_hash, item_id, first_word, n_words, n_equal."""
    spark = docs.sparkSession
    prepare_workers(spark)
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"), docs[text_col].alias("text"))
    items = benchmark_seeds(benchmark, item_id_col, item_text_col, block_words)
    bits, masks = seed_filter(items)
    shared = spark.sparkContext.broadcast(bits)
    passed = stash(rows.mapInArrow(lambda batches: _seeds(batches, masks, shared.value), SEEDS), "decontaminate-seeds")
    shared.destroy()
    good = _join(passed, items).drop("seed", "salt").mapInArrow(_verify, GOOD)
    diagonal = ("id", "text_hash", "item_id", "item_hash", "diagonal")
    blocks = good.groupBy(*diagonal, "block", "first", "last").agg(F.bit_or("equal").alias("equal"))
    per = blocks.groupBy(*diagonal).agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("windows"), F.collect_list(F.struct("block", "equal")).alias("bits"))
    found = per.withColumn("o", F.explode(_touching(F.col("windows"))))  # what a diagonal gathers is bounded by the item
    # equal words of an overlap: the blocks' bits joined, and cut to the overlap
    inside = F.expr("""transform(bits, b -> named_struct('block', b.block, 'equal', b.equal
        & (case when o.last - 64 * b.block >= 64 then -1L when o.last <= 64 * b.block then 0L else ~shiftleft(-1L, o.last - 64 * b.block) end)
        & ~(case when o.first - 64 * b.block >= 64 then -1L when o.first <= 64 * b.block then 0L else ~shiftleft(-1L, o.first - 64 * b.block) end)))""")
    joined = F.expr("aggregate(inside, 0, (n, b) -> n + bit_count(b.equal))")
    merged = found.withColumn("bits", F.expr("""transform(array_distinct(bits.block), k -> named_struct('block', k,
        'equal', aggregate(filter(bits, b -> b.block = k), 0L, (x, b) -> x | b.equal)))""")).withColumn("inside", inside)
    return merged.select("id", "text_hash", "item_id", F.col("o.first").alias("first_word"), (F.col("o.last") - F.col("o.first")).alias("n_words"), joined.cast("int").alias("n_equal"))


def _touching(windows) -> Column:
    """Sorted windows (first, last) as the stretches that they cover without a gap."""
    none = F.array().cast("array<struct<first:int,last:int>>")

    def add(out, w):
        end = F.get(out, F.size(out) - 1)
        grown = F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(end["first"].alias("first"), F.greatest(end["last"], w["last"]).alias("last"))))
        return F.when(w["first"] <= F.coalesce(end["last"], F.lit(-1)), grown).otherwise(F.concat(out, F.array(w)))

    return F.aggregate(windows, none, add)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """id, text_hash, n_items, items (ids, ascending), n_words (of the longest overlap); only rows with an overlap."""
    hits = find_overlaps(docs, benchmark, id_col, text_col, **kw)
    per = hits.groupBy("id", "text_hash").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("n_words").alias("overlap_words"))
    return per.select("id", "text_hash", F.size("items").cast("long").alias("n_items"), "items", F.col("overlap_words").cast("long").alias("overlap_words"))


def mark_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(id, contaminated, n_items, items, overlap_words) for every row."""
    found = stash(contaminated(docs, benchmark, id_col, text_col, **kw), "contaminated")
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash")).alias("d")
    f = found.select(F.col("id").alias("f_id"), F.col("text_hash").alias("f_hash"), "n_items", "items", "overlap_words")
    joined = rows.join(f, F.col("text_hash").eqNullSafe(F.col("f_hash")) & F.col("id").eqNullSafe(F.col("f_id")), "left")
    return joined.select("id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                         F.coalesce("items", F.array().cast("array<bigint>")).alias("items"), F.coalesce("overlap_words", F.lit(0)).cast("long").alias("overlap_words"))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The rows of ``docs``, all columns, that overlap no item."""
    found = stash(contaminated(docs, benchmark, id_col, text_col, **kw), "contaminated").select(F.col("id").alias("f_id"), F.col("text_hash").alias("f_hash"))
    # the row as one column, so that no name of the input can clash
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), docs[id_col].cast("long").alias("id"), F.xxhash64(docs[text_col]).alias("text_hash"))
    same = F.col("id").eqNullSafe(F.col("f_id")) & F.col("text_hash").eqNullSafe(F.col("f_hash"))
    kept = rows.join(found.hint("shuffle_hash"), same, "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])
