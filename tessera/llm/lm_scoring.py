"""LM scoring: stupid-backoff scores from n-gram counts of a whole corpus, order by order.

Words are lower-cased (A-Z) runs of non-whitespace; n-grams of 1 to ``order`` words are told apart by 64-bit hashes.

1. blocks: an Arrow batch of documents as one row - ids, lengths, and as bytes, which Spark copies whole, word hashes and word numbers (written once,
   in buckets by block: what is joined to blocks comes to them, and they are never shuffled);
2. exploded n-grams of one order: a row for each n-gram of a block, with its occurrences there, partitioned by hash (a block sends
   an n-gram once, however frequent it is, so no hash is hot);
3. the count table of the order, ``groupBy(hash)``, joined back to the exploded n-grams in the same partitioning;
4. the joined counts of a partition return to their blocks as one row for each block; of each order but the last the counts by word are kept
   beside the blocks, in the same buckets, and after the last logarithms are summed per document.

The score of word i is count(n-gram) / count(its first n - 1 words) for the longest n whose n-gram was seen, times ``alpha`` for every
order given up; an unseen word counts as alpha times one occurrence. With ``leave_one_out`` a document's own occurrences are subtracted
everywhere, so that no document vouches for itself.

An n-gram that one document alone holds counts 0 for that document once its own occurrences are left out, and so does every longer
n-gram around it. So an order explodes only n-grams both of whose shorter parts are kept, and keeps those that two documents hold: an
exact cut, like the one of n-grams that the corpus does not hold where nothing is left out. Each order but the first runs in ``PASSES``
ranges of hashes, and what a pass shuffled is freed before the next.

All n-grams of all documents are counted: nothing is pruned otherwise, capped or sampled. Edge cases: null or empty texts have no words, score 0
and a null mean; a text of any length stays in one block, whose n-grams are spread over the partitions; repeated rows are copies of each other; an empty corpus leaves only unseen words; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ARROW_BATCH_BYTES, WHITESPACE, drop_stash, prepare_workers, rows_of_numbers, shuffles_freed, stash, stash_buckets, text_bytes

ORDER = 3
ALPHA = 0.4
#: Words asked or counted for each partition of a pass.
RANGE_GRAMS = 2_000_000
#: Bytes of text for each bucket of blocks.
BUCKET_BYTES = ARROW_BATCH_BYTES
#: Ranges of hashes that are counted one after the other; bounds the disk that an order takes.
PASSES = 3
_MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
BLOCKS = "block long, ids array<long>, lengths array<long>, word_hashes binary, word_numbers binary, n_words long"
#: seen: counts by word, of 32 bits, or 64 where a count needs it.
KEPT = "block long, kept binary, seen{n} binary"
#: cell: place << 33 | (two or more documents of the block hold it) << 32 | occurrences. Count table and exploded n-grams read the same three columns, so they share one shuffle.
GRAMS = "hash long, block long, cell long"
#: places: differences of 32-bit places; totals: 32-bit counts, 64-bit ones where a count needs it.
TOTALS = "block long, n int, pass int, places binary, totals binary"
#: A sum of a count table: blocks where two documents hold the n-gram above this bit, occurrences below.
_SEVERAL = 40
#: Joined counts that are sorted by block at once.
_TOTALS_ROWS = 1 << 20
#: 1 for each byte of a word, 0 for whitespace.
_NO_SPACE = bytes(c not in WHITESPACE.encode() for c in range(256))
#: The first so many bytes of eight.
_FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX[1]
    x = (x ^ (x >> np.uint64(29))) * _MIX[2]
    return x ^ (x >> np.uint64(32))


def _word_hashes(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of every word: its length, then eight bytes at a time; words over 64 bytes by xxh64."""
    eights = np.ndarray(len(data) + 1, "<u8", data + bytes(8), strides=(1,))
    out = lengths.astype(np.uint64) * _MIX[0]
    at, left, mine = starts, lengths, slice(None)
    for _ in range(8):
        some = eights[at]
        some &= _FIRST_BYTES[np.minimum(left, 8)]
        out[mine] = _mixed(out[mine] ^ some)
        more = np.flatnonzero(left > 8)
        mine = more if isinstance(mine, slice) else mine[more]
        at, left = at[more] + 8, left[more] - 8
        if not len(more):
            return out
    for k in mine.tolist():
        out[k] = xxhash.xxh64_intdigest(data[starts[k]:starts[k] + lengths[k]])
    return out


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of words of every text, hashes of the distinct words, lower-cased, as they first occur, which of these each word is)."""
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64) if len(texts) else np.zeros(1, np.int64)
    data = bytes(data[offsets[0]:offsets[-1]]).lower() if data else b""
    offsets -= offsets[0]
    inside = np.frombuffer(data.translate(_NO_SPACE), bool)
    edge = np.ones(len(data) + 1, bool)  # between two bytes where a word may begin or end: no word goes on where a text begins
    edge[1:-1] = ~(inside[1:] & inside[:-1])
    edge[offsets] = True
    starts = np.flatnonzero(edge[:-1] & inside)
    hashes = _word_hashes(data, starts, np.flatnonzero(edge[1:] & inside) + 1 - starts)
    by, heads = _sorted(hashes)
    first = by[heads]
    order = np.argsort(first)
    rank = np.empty(len(first), np.int32)
    rank[order] = np.arange(len(first), dtype=np.int32)
    numbers = np.empty(len(hashes), np.int32)
    numbers[by] = rank[np.cumsum(heads) - 1]
    return np.diff(np.searchsorted(starts, offsets)), hashes[first[order]], numbers


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    task = TaskContext.get()
    first = (task.partitionId() if task else 0) << 32
    for k, batch in enumerate(batches):
        lengths, hashes, numbers = _words(batch.column("text").fill_null(b""))
        values = ([first + k], [batch.column("id").to_pylist()], [lengths], [hashes.tobytes()], [numbers.tobytes()], [len(numbers)])
        types = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names=["block", "ids", "lengths", "word_hashes", "word_numbers", "n_words"])


def to_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = 1) -> DataFrame:
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_bytes(docs[text_col]).alias("text"))
    return stash_buckets(rows.mapInArrow(_blocks, BLOCKS), "lm-blocks", "block", buckets, "zstd")


class Block:
    """One row of blocks as arrays: the document of every word and its place in it, and n-grams by where they end."""

    def __init__(self, batch: pa.RecordBatch, k: int):
        self.number = batch.column("block")[k].as_py()
        self.lengths = batch.column("lengths")[k].values.to_numpy(zero_copy_only=False).astype(np.int64)
        self.word_hashes = np.frombuffer(batch.column("word_hashes")[k].as_py(), np.uint64)
        self.word_numbers = np.frombuffer(batch.column("word_numbers")[k].as_py(), np.int32)
        self.words = self.word_hashes[self.word_numbers]
        self.doc = np.repeat(np.arange(len(self.lengths), dtype=np.int32), self.lengths)
        self.inside = np.arange(len(self.words)) - np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)

    def hashes(self, n: int) -> np.ndarray:
        """Hash of the n-gram that ends at every word; without meaning where a document has no n words so far."""
        out = self.words
        for size in range(2, n + 1):
            out = np.concatenate((np.zeros(1, np.uint64), (out[:-1] * _MIX[0]) ^ (self.words[1:] * _MIX[1]) ^ np.uint64(size)))[:len(self.words)]
            out = (out ^ (out >> np.uint64(31))) * _MIX[2]
        return out

    def candidates(self, n: int, kept: np.ndarray | None) -> np.ndarray:
        """Where n-grams end both of whose shorter parts are kept; ``kept``: words where a kept (n - 1)-gram ends."""
        whole = self.inside >= n - 1
        if n > 1 and kept is not None:
            whole[1:] &= kept[1:] & kept[:-1]
        return np.flatnonzero(whole)


def _pass_of(hashes: np.ndarray, passes: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(passes)) >> np.uint64(32)


def _passes(n: int, passes: int) -> int:
    """Single words are few beside n-grams: one pass."""
    return 1 if n == 1 else passes


def _sorted(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the hashes, equal ones as they come, whether each in this order is the first of its kind); sorts plain numbers, hashes with their index in the low bits."""
    size = len(hashes)
    low = np.uint64((1 << size.bit_length()) - 1)
    keyed = (hashes & ~low) | np.arange(size, dtype=np.uint64)
    keyed.sort()
    by = (keyed & low).astype(np.int64)
    ordered = hashes[by]
    new = ordered[1:] != ordered[:-1]
    if (new & ((keyed[1:] ^ keyed[:-1]) <= low)).any():  # two hashes differ in the low bits only
        by = np.argsort(hashes, kind="stable")
        ordered = hashes[by]
        new = ordered[1:] != ordered[:-1]
    return by, np.concatenate((np.ones(min(1, size), bool), new))


def _groups(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of every hash among the distinct ones, these in ascending order)."""
    by, heads = _sorted(hashes)
    place = np.empty(len(hashes), np.int64)
    place[by] = np.cumsum(heads) - 1
    return place, hashes[by[heads]]


def _own_in_order(doc: np.ndarray, by: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """For every n-gram in the order of ``_sorted`` its occurrences in its own document; documents ascend."""
    docs = doc[by]
    runs = heads.copy()
    runs[1:] |= docs[1:] != docs[:-1]
    return np.repeat(lengths := np.diff(np.flatnonzero(runs), append=len(by)), lengths)


def _own(doc: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For every n-gram its occurrences in its own document."""
    by, heads = _sorted(hashes)
    out = np.empty(len(hashes), np.int64)
    out[by] = _own_in_order(doc, by, heads)
    return out


def _of_pass(at: np.ndarray, hashes: np.ndarray, number: int, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """(where the n-grams of a pass end, their hashes)."""
    if passes == 1:
        return at, hashes
    mine = np.flatnonzero(_pass_of(hashes, passes) == number)
    return at[mine], hashes[mine]


def _explode(batches: Iterator[pa.RecordBatch], n: int, number: int, passes: int, counted: bool) -> Iterator[pa.RecordBatch]:
    """The distinct n-grams of each block in one pass: place among them, whether two documents hold it, occurrences."""
    for batch in batches:
        for k in range(batch.num_rows):
            block = Block(batch, k)
            at = block.candidates(n, _kept(batch, k, len(block.words)))
            at, hashes = _of_pass(at, block.hashes(n)[at], number, passes)
            by, heads = _sorted(hashes)
            starts = np.flatnonzero(heads)
            ends = np.append(starts[1:], len(by)) if len(by) else starts
            docs = block.doc[at]
            several = docs[by[starts]] != docs[by[ends - 1]]
            cells = np.arange(len(starts)) << 33 | several.astype(np.int64) << 32 | (ends - starts) * counted
            hashes = hashes[by[starts]].view(np.int64)
            for a in range(0, len(hashes), 1 << 17):
                b = min(a + (1 << 17), len(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (hashes[a:b], np.full(b - a, block.number), cells[a:b])], names=["hash", "block", "cell"])


def _kept(batch: pa.RecordBatch, k: int, n_words: int) -> np.ndarray | None:
    if "kept" not in batch.schema.names:
        return None
    return np.unpackbits(np.frombuffer(batch.column("kept")[k].as_py(), np.uint8), count=n_words).astype(bool)


def _totals(batches: Iterator[pa.RecordBatch], n: int, number: int) -> Iterator[pa.RecordBatch]:
    """The joined counts of a partition as a row for each block and some ``_TOTALS_ROWS`` of them."""
    def rows(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        block, place, total = (np.concatenate([b.column(c).to_numpy() for b in some]) for c in ("block", "place", "total"))
        codes = pa.array(block).dictionary_encode().indices.to_numpy()
        by = np.argsort(codes.astype(np.uint16) if codes.max() < 1 << 16 else codes, kind="stable")  # of 16 bits: in linear time
        block, place, total = block[by], place[by], total[by]
        edges = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1).tolist(), len(block)]
        parts = list(zip(edges, edges[1:]))
        places = [np.diff(place[a:b], prepend=np.int32(0)).astype("<i4").tobytes() for a, b in parts]
        totals = [total[a:b].astype("<i4" if total[a:b].max() < 1 << 31 else "<i8").tobytes() for a, b in parts]
        columns = (block[edges[:-1]], np.full(len(parts), n, np.int32), np.full(len(parts), number, np.int32))
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(places, pa.binary()), pa.array(totals, pa.binary())],
                                          names=["block", "n", "pass", "places", "totals"])

    some, size = [], 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            size += batch.num_rows
        if size >= _TOTALS_ROWS:
            yield rows(some)
            some, size = [], 0
    if size:
        yield rows(some)


Answers = dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]]


def _by_word(block: Block, n: int, kept: np.ndarray | None, passes: int, answers: Answers, leave_one_out: bool) -> tuple[np.ndarray, np.ndarray]:
    """(whether the n-gram that ends at a word is kept, its count, with ``leave_one_out`` without its own document's)."""
    is_kept, out = np.zeros(len(block.words), bool), np.zeros(len(block.words), np.int64)
    all_at = block.candidates(n, kept)
    all_hashes = block.hashes(n)[all_at]
    for p in range(passes):
        if (n, p) not in answers:
            continue
        at, hashes = _of_pass(all_at, all_hashes, p, passes)
        by, heads = _sorted(hashes)
        totals = np.zeros(np.count_nonzero(heads), np.int64)
        for places, some in answers[n, p]:
            totals[places] = some
        counts, at = np.repeat(totals, np.diff(np.flatnonzero(heads), append=len(by))), at[by]
        is_kept[at] = counts > 0
        out[at] = counts - _own_in_order(block.doc, at, heads) * (counts > 0) if leave_one_out else counts
    return is_kept, out


def _answers(batch: pa.RecordBatch, k: int) -> Answers:
    """(places, counts) of each order and pass."""
    out: Answers = defaultdict(list)
    listed = batch.column("answers")[k]
    if listed.is_valid:
        for n, p, places, totals in zip(*(listed.values.field(c).to_pylist() for c in ("n", "pass", "places", "totals"))):
            width = "<i4" if len(totals) == len(places) else "<i8"
            out[n, p].append((np.cumsum(np.frombuffer(places, "<i4")), np.frombuffer(totals, width)))
    return out


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype("<i4" if not len(counts) or np.abs(counts).max() < 1 << 31 else "<i8").tobytes()


def _unpacked(counts: bytes, n_words: int) -> np.ndarray:
    return np.frombuffer(counts, "<i4" if len(counts) == 4 * n_words else "<i8").astype(np.int64)


def _keep(batches: Iterator[pa.RecordBatch], n: int, passes: int, leave_one_out: bool) -> Iterator[pa.RecordBatch]:
    """For every block one bit for each word, whether the n-gram that ends there is kept, and the counts of these n-grams by word."""
    for batch in batches:
        for k in range(batch.num_rows):
            block = Block(batch, k)
            kept, counts = _by_word(block, n, _kept(batch, k, len(block.words)), _passes(n, passes), _answers(batch, k), leave_one_out)
            yield pa.RecordBatch.from_arrays([pa.array([block.number]), pa.array([np.packbits(kept).tobytes()], pa.binary()), pa.array([_packed(counts)], pa.binary())],
                                             names=["block", "kept", f"seen{n}"])


def document_scores(block: Block, seen: list[np.ndarray], corpus_words: int, alpha: float, leave_one_out: bool) -> np.ndarray:
    """Sum of log scores of every document of a block; ``seen``: for each order the count of the n-gram that ends at every word."""
    n_words = len(block.words)
    if not n_words:
        return np.zeros(len(block.lengths))
    known = np.maximum(corpus_words - block.lengths[block.doc] * leave_one_out, 1).astype(float)
    score, given_up, open_ = np.zeros(n_words), np.zeros(n_words), np.ones(n_words, bool)
    for n in range(len(seen), 0, -1):
        counts = seen[n - 1]
        below = known if n == 1 else np.concatenate(([1.0], seen[n - 2][:-1]))[:n_words]
        found = open_ & (counts > 0) & (block.inside >= n - 1)
        score[found] = counts[found] / below[found]
        open_ &= ~found
        given_up += open_ & (block.inside >= n - 1)
    score[open_] = 1 / known[open_]
    return np.bincount(block.doc, np.log(score) + given_up * np.log(alpha), len(block.lengths))


def _score(batches: Iterator[pa.RecordBatch], order: int, passes: int, corpus_words: int, alpha: float, leave_one_out: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            block = Block(batch, k)
            _, last = _by_word(block, order, _kept(batch, k, len(block.words)), _passes(order, passes), _answers(batch, k), leave_one_out)
            seen = [_unpacked(batch.column(f"seen{n}")[k].as_py(), len(block.words)) for n in range(1, order)]
            sums = document_scores(block, [*seen, last], corpus_words, alpha, leave_one_out)
            yield pa.RecordBatch.from_arrays([batch.column("ids")[k].values, pa.array(block.lengths), pa.array(sums)], names=["id", "n_words", "log_score"])


def count_pass(asking: DataFrame, corpus: DataFrame | None, n: int, number: int, passes: int, parts: int, alone: bool) -> DataFrame:
    """block, n, pass, places, totals: the counts of the kept n-grams of every block in one pass; ``alone``: those that one document holds count nothing."""
    counted = corpus is None
    exploded = asking.mapInArrow(lambda b: _explode(b, n, number, passes, counted), GRAMS)
    if corpus is not None:
        exploded = exploded.unionByName(corpus.mapInArrow(lambda b: _explode(b, n, number, passes, True), GRAMS).withColumn("block", F.lit(-1).cast("long")))
    grams = exploded.repartition(parts, "hash")  # counted and joined in one partitioning
    own, several = F.col("cell").bitwiseAND(F.lit((1 << 32) - 1)), F.shiftright("cell", 32).bitwiseAND(F.lit(1))
    summed = F.sum(own + F.shiftleft(several, _SEVERAL)).alias("summed")
    total = F.col("summed").bitwiseAND(F.lit((1 << _SEVERAL) - 1))
    held = (F.col("blocks") > 1) | (F.shiftright("summed", _SEVERAL) > 0) if alone else (F.col("blocks") > 0) & (total > 0)
    counts = grams.groupBy(F.col("hash").alias("of")).agg(summed, F.count("block").alias("blocks")).where(held).select("of", total.alias("total"))
    joined = grams.join(counts.hint("shuffle_hash"), F.col("hash") == F.col("of")).select("block", F.shiftright("cell", 33).cast("int").alias("place"), "total")
    if not counted:
        joined = joined.where("block >= 0")
    return joined.mapInArrow(lambda b: _totals(b, n, number), TOTALS)


def _with_answers(blocks: DataFrame, totals: DataFrame, buckets: int) -> DataFrame:
    """Blocks, which stay in their buckets, with their counts."""
    per_block = totals.repartition(buckets, "block").groupBy(F.col("block").alias("of")).agg(F.collect_list(F.struct("n", "pass", "places", "totals")).alias("answers"))
    return blocks.join(per_block, F.col("block") == F.col("of"), "left").drop("of")


def score_documents(docs: DataFrame, corpus: DataFrame | None = None, order: int = ORDER, alpha: float = ALPHA, leave_one_out: bool | None = None,
                    id_col: str = "doc_id", text_col: str = "text", passes: int = PASSES) -> DataFrame:
    """id, n_words, log_score (sum of natural logs) and mean_log_score of every row of ``docs``, by the n-grams of ``corpus`` (default: the
    documents themselves, leaving each document's own occurrences out)."""
    leave_one_out = corpus is None if leave_one_out is None else leave_one_out
    alone = corpus is None and leave_one_out
    with shuffles_freed(docs.sparkSession):
        size = docs.agg(F.sum(F.octet_length(text_bytes(docs[text_col])))).first()[0] or 0
        buckets = max(1, -(-size // BUCKET_BYTES))
        blocks = to_blocks(docs, id_col, text_col, buckets)
        counted = None if corpus is None else to_blocks(corpus, id_col, text_col)
        asked = blocks.agg(F.sum("n_words")).first()[0] or 0
        corpus_words = asked if counted is None else counted.agg(F.sum("n_words")).first()[0] or 0
        parts = max(1, -(-(corpus_words + asked) // (2 * RANGE_GRAMS)))
        words = asking = blocks.drop("ids", "n_words")
        whole = blocks.drop("n_words")
        for n in range(1, order + 1):
            with rows_of_numbers(docs.sparkSession):
                totals = [stash(count_pass(asking, counted, n, p, _passes(n, passes), parts, alone), "lm-totals", "zstd") for p in range(_passes(n, passes))]
            if n < order:
                answered = _with_answers(asking, reduce(DataFrame.unionByName, totals), buckets)
                kept = stash_buckets(answered.mapInArrow(lambda b, n=n: _keep(b, n, passes, leave_one_out), KEPT.format(n=n)), "lm-kept", "block", buckets, "zstd")
                for old in totals:
                    drop_stash(old)
                asking = words.join(kept.select("block", "kept").hint("shuffle_hash"), "block")  # bits are small: no sort of the blocks
                whole = whole.join(kept if n == order - 1 else kept.drop("kept"), "block")
    answered = _with_answers(whole, reduce(DataFrame.unionByName, totals), buckets)
    scored = answered.mapInArrow(lambda b: _score(b, order, passes, corpus_words, alpha, leave_one_out), "id long, n_words long, log_score double")
    return scored.withColumn("mean_log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")))
