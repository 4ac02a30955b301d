"""Suffix-array dedup: remove every byte covered by a ``MIN_BYTES``-byte string that also starts elsewhere.

Candidates. Every window of ``MIN_BYTES`` bytes names an anchor: the leftmost of its ``GRAM``-byte grams with the least hash.
Equal windows name equal grams at equal places, so a window whose anchor gram is an anchor nowhere else is
unique, and such windows leave the work exactly. The others are grouped by anchor gram. The context of an
anchor holds all bytes of the windows that name it; contexts that occur twice or more repeat as a whole (this collapses
copies before anything is sorted), and only grams with differing contexts go on.

Suffix arrays. Contexts are dealt to shards by gram. A shard sorts its suffixes by Larsson-Sadakane refinement
(groups of equal prefixes are split by the rank of what follows, with doubled depth, and sorted suffixes are left alone),
takes Kasai common prefixes between neighbours, and marks the starts with a common prefix of ``MIN_BYTES``. Contexts of a gram with
more than ``GRAM_CONTEXTS`` contexts are split over several shards; those send their sorted classes of
windows to merge tasks, which find classes of other shards by binary search.

All positions are bytes of the UTF-8 text; matches never cross documents, and what is removed is judged on the input.

Edge cases: null or empty texts have no byte and no span; texts shorter than ``MIN_BYTES`` lose nothing; repeated rows are
copies of each other, also with equal ids; an empty table gives an empty result; other columns are ignored. Rows are told apart by a
64-bit hash of id and text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers, stash, text_bytes

MIN_BYTES = 200
GRAM = 48
#: Windows up to this length name an anchor at most 1023 bytes behind their first byte, which ``place`` holds in 10 bits.
MOST_BYTES = 1023 + GRAM
#: Text that is hashed at once, in bytes; longer documents go in overlapping pieces.
PIECE = 1 << 20
#: Bytes of contexts in a shard, about.
SHARD_BYTES = 1 << 20
GRAM_CONTEXTS = 2048
_POSITION_BITS = 22
ANCHORS = "row long, gram long, context long, place long"


@lru_cache(1)
def _mixers() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(5)
    return rng.integers(0, 1 << 63, 256, dtype=np.uint64), rng.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _folded(x: np.ndarray, width: int, join) -> np.ndarray:
    """``join`` over every window of ``width`` values, by doubling; join(left, right, shift)."""
    have, size, powers = x, 1, {1: x}
    while size * 2 <= width:
        have = join(have[:-size], have[size:], size)
        size *= 2
        powers[size] = have
    rest = width - size
    if not rest:
        return have
    if join is _least:  # windows may overlap
        return _least(have[:-rest], have[rest:], rest)
    tail = powers[rest] if rest in powers else _folded(x, rest, join)
    n = len(x) - width + 1
    return join(have[:n], tail[size:size + n], size)


def _least(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    return np.minimum(a, b)


def _hash_join(a: np.ndarray, b: np.ndarray, shift: int) -> np.ndarray:
    return a * _mixers()[1][shift.bit_length()] + b


def anchors(data: bytes, ends: np.ndarray, min_bytes: int = MIN_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor, gram hash) of every anchor in texts laid end to end; ``ends``: where each text ends."""
    n = len(data) - min_bytes + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    table, odd = _mixers()
    grams = _folded(table[np.frombuffer(data, np.uint8)], GRAM, _hash_join)
    grams ^= grams >> np.uint64(32)
    grams *= odd[40]
    low = np.uint64((1 << _POSITION_BITS) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    least = _folded(keys, min_bytes - GRAM + 1, _least)
    at = (least & low).astype(np.int32)
    whole = np.ones(n, bool)
    for end in ends.tolist():
        whole[max(0, end - min_bytes + 1):min(n, end)] = False
    opens = whole.copy()
    opens[1:] &= (at[1:] != at[:-1]) | ~whole[:-1]
    closes = whole.copy()
    closes[:-1] &= (at[1:] != at[:-1]) | ~whole[1:]
    first, last = np.flatnonzero(opens), np.flatnonzero(closes)
    anchor = at[first].astype(np.int64)
    return first, last, anchor, grams[anchor]


def _units(texts: list[bytes], min_bytes: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, ends, text number of each part, offset of each part in its text), about ``PIECE`` bytes each."""
    parts: list[tuple[bytes, int, int]] = []
    size = 0
    for d, text in enumerate(texts):
        for at in range(0, max(0, len(text) - min_bytes + 1), PIECE):
            part = text[at:at + PIECE + min_bytes - 1]
            if parts and size + len(part) > PIECE + min_bytes:
                yield _unit(parts)
                parts, size = [], 0
            parts.append((part, d, at))
            size += len(part)
    if parts:
        yield _unit(parts)


def _unit(parts):
    return (b"".join(p for p, _, _ in parts), np.cumsum([len(p) for p, _, _ in parts]), np.array([d for _, d, _ in parts]), np.array([o for _, _, o in parts]))


def _find_anchors(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    """place: first window << 20 | (windows - 1) << 10 | anchor behind the first window."""
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for data, ends, text, offset in _units(batch.column("text").to_pylist(), min_bytes):
            first, last, anchor, gram = anchors(data, ends, min_bytes)
            part = np.searchsorted(ends, first, "right")
            starts = np.concatenate(([0], ends[:-1]))
            shape = ((last - first) << 10) | (anchor - first)
            digest = xxhash.xxh64_intdigest
            context = np.array([digest(data[a:b], s) for a, b, s in zip(first.tolist(), (last + min_bytes).tolist(), shape.tolist())], np.uint64)
            place = ((first - starts[part] + offset[part]) << 20) | shape
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[text[part]]), pa.array(gram.view(np.int64)), pa.array(context.view(np.int64)), pa.array(place)], names=["row", "gram", "context", "place"])


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position on, as little-endian numbers; zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out |= padded[k:k + len(data)].astype(np.uint64) << np.uint64(8 * k)
    return out


def _order_of(keys: np.ndarray, key_bits: int) -> np.ndarray:
    """Like argsort; where key and index fit into 64 bits, one plain sort of both is several times faster."""
    bits = max(1, int(len(keys) - 1).bit_length())
    if key_bits + bits > 63:
        return np.argsort(keys)
    packed = (keys.astype(np.uint64) << np.uint64(bits)) | np.arange(len(keys), dtype=np.uint64)
    packed.sort()
    return (packed & np.uint64((1 << bits) - 1)).astype(np.int64)


def suffix_array(words: np.ndarray, ends: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order, rank of every suffix), by Larsson-Sadakane refinement. ``ends`` gives for every position where its
    text ends; an end sorts by its position, so suffixes of different texts never compare beyond their texts and the
    depth stays below the longest text. Without it the whole is one text, and its end sorts before every byte."""
    n = len(words)
    ends = np.full(n, n) if ends is None else ends
    depth = 5
    first = words.byteswap() >> np.uint64(64 - 8 * depth)
    over = (8 * np.maximum(0, np.arange(n) + depth - ends - (ends < n))).astype(np.uint64)
    first = np.where(over < 8 * depth, first >> over << over, first)  # no byte behind an end counts
    order = _order_of(first, 8 * depth)
    rank = np.full(n + 1, -1, np.int64)
    heads = np.concatenate(([True], (first[order][1:] != first[order][:-1]) | (ends[order][1:] == order[1:])))
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n), 0))
    slots = _unsorted(heads, np.arange(n))
    key_bits = 2 * int(n + 2).bit_length()
    while len(slots):
        members = order[slots]
        key = rank[members] * (n + 2) + rank[np.minimum(members + depth, ends[members])] + 1
        by = _order_of(key, key_bits)
        members, key = members[by], key[by]
        order[slots] = members
        heads = np.concatenate(([True], key[1:] != key[:-1]))
        rank[members] = slots[np.maximum.accumulate(np.where(heads, np.arange(len(slots)), 0))]
        slots = _unsorted(heads, slots)
        depth *= 2
    return order, rank[:n]


def _unsorted(heads: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """The slots of groups of two or more."""
    return slots[~(heads & np.concatenate((heads[1:], [True])))]


def kasai(words: np.ndarray, order: np.ndarray, rank: np.ndarray, cap: int, ends: np.ndarray | None = None, lane: int = 256) -> np.ndarray:
    """Common prefix, up to ``cap`` and the texts' ends, of every suffix (by position) with its predecessor in ``order``. Kasai's rule -
    going one position on shortens the common prefix by one at most - runs in lanes of ``lane`` positions side by side, 8 bytes a step."""
    n = len(order)
    ends = np.full(n, n) if ends is None else ends
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    position = np.arange(n)
    limit = np.where(before >= 0, np.minimum(cap, np.minimum(ends - position, (ends - position)[before])), 0)
    common = np.zeros(n, np.int64)
    starts = np.arange(0, n, lane)
    length = np.zeros(len(starts), np.int64)
    for t in range(min(lane, n)):
        i = starts + t
        here = np.flatnonzero(i < n)
        i = i[here]
        j, most = before[i], limit[i]
        found = np.minimum(np.maximum(length[here] - 1, 0), most)
        going = np.flatnonzero(found < most)
        while len(going):
            differ = words[i[going] + found[going]] ^ words[j[going] + found[going]]
            equal = np.bitwise_count((differ & (~differ + np.uint64(1))) - np.uint64(1)) >> 3  # of 0 all 64 bits count
            found[going] += equal
            going = going[(differ == 0) & (found[going] < most[going])]
        found = np.minimum(found, most)
        length[here] = found
        common[i] = found
    return common


def repeated_starts(contexts: list[bytes], min_bytes: int = MIN_BYTES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every window start of the contexts: (context number, offset, found twice or more here, class). Classes number the
    different windows in sorted order."""
    data = np.frombuffer(b"\xff".join(contexts) + b"\xff", np.uint8)
    lengths = np.array([len(c) for c in contexts])
    begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    windows = np.maximum(lengths - min_bytes + 1, 0)
    number = np.repeat(np.arange(len(contexts)), windows)
    offset = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    at = begins[number] + offset
    words = _words(data)
    ends = np.repeat(begins + lengths, lengths + 1)
    order, rank = suffix_array(words, ends)
    common = kasai(words, order, rank, min_bytes, ends)
    is_start = np.zeros(len(data), bool)
    is_start[at] = True
    ordered = order[is_start[order]]  # windows in sorted order; equal ones are neighbours, and no other suffix stands between them
    linked = (common[ordered] >= min_bytes) & np.concatenate(([False], is_start[order[np.maximum(rank[ordered[1:]] - 1, 0)]])) if len(ordered) else np.zeros(0, bool)
    repeated = linked | np.concatenate((linked[1:], [False])) if len(ordered) else linked
    found, classes = np.zeros(len(data), bool), np.zeros(len(data), np.int64)
    found[ordered], classes[ordered] = repeated, np.cumsum(~linked) - 1
    return number, offset, found[at], classes[at]


def _runs(offsets: np.ndarray) -> list[tuple[int, int]]:
    """(first, behind the last) of runs of consecutive numbers."""
    if not len(offsets):
        return []
    cut = np.flatnonzero(np.diff(offsets) != 1)
    return list(zip(offsets[np.concatenate(([0], cut + 1))].tolist(), (offsets[np.concatenate((cut, [len(offsets) - 1]))] + 1).tolist()))


def _shard(frame: pd.DataFrame, min_bytes: int) -> pd.DataFrame:
    """Runs of repeated windows of each context; for split grams also the classes that other shards must see."""
    frame = frame.drop_duplicates(["gram", "context"]).sort_values(["gram", "context"]).reset_index(drop=True)
    contexts = frame["data"].tolist()
    number, offset, found, classes = repeated_starts(contexts, min_bytes)
    grams, names, alone = frame["gram"].to_numpy(np.int64), frame["context"].to_numpy(np.int64), (frame["n"] == 1).to_numpy()
    bounds = np.searchsorted(number, np.arange(len(contexts) + 1))
    out = []
    for k in range(len(contexts)):
        if alone[k]:
            own = slice(bounds[k], bounds[k + 1])
            out += [(grams[k], names[k], a, b, None) for a, b in _runs(offset[own][found[own]])]
    split = np.flatnonzero((frame["salts"] > 1).to_numpy()[number])
    for x in split[np.unique(classes[split], return_index=True)[1]].tolist():
        k, at = number[x], int(offset[x])
        asks = not found[x] and alone[k]
        out.append((grams[k], names[k], at, at + 1 if asks else at, xxhash.xxh3_128_digest(contexts[k][at:at + min_bytes])))
    return pd.DataFrame(out, columns=["gram", "context", "first", "behind", "window"]).astype({"gram": "int64", "context": "int64", "first": "int64", "behind": "int64", "window": object})


def _merge(frame: pd.DataFrame) -> pd.DataFrame:
    """Windows that another shard of the same gram holds too. Every shard sends a class once, so a class found
    twice in the sorted list is shared; rows with first = behind only answer."""
    windows = np.sort(np.array([w for w in frame["window"]], dtype="S16"))
    own = np.array([w for w in frame["window"]], dtype="S16")
    shared = np.searchsorted(windows, own, "right") - np.searchsorted(windows, own, "left") > 1
    return frame.loc[shared & (frame["behind"] > frame["first"]), ["gram", "context", "first", "behind"]]


def _cut_contexts(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        grams, names, ns, salts, data = [], [], [], [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            for w in wanted:
                first, windows = w["place"] >> 20, ((w["place"] >> 10) & 1023) + 1
                grams.append(w["gram"]), names.append(w["context"]), ns.append(w["n"]), salts.append(w["salts"])
                data.append(text[first:first + windows - 1 + min_bytes])
        arrays = [pa.array(x, pa.int64()) for x in (grams, names, ns, salts)] + [pa.array(data, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, names=["gram", "context", "n", "salts", "data"])


def _apply(batches: Iterator[pa.RecordBatch], min_bytes: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            spans = merged_spans([(r["first"], r["behind"] + min_bytes - 1) for r in runs or []])
            kept, at = [], 0
            for a, b in spans:
                kept.append(text[at:a])
                at = b
            kept.append(text[at:])
            out.append((len(text), sum(b - a for a, b in spans), [{"start": a, "end": b} for a, b in spans], b"".join(kept)))
        columns = list(zip(*out)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
        arrays = [batch.column("id"), *(pa.array(list(c), t) for c, t in zip(columns, types))]
        yield pa.RecordBatch.from_arrays(arrays, names=["id", "n_bytes", "n_removed", "spans", "kept"])


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of overlapping or touching (start, end)."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def repeated_windows(rows: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(row, first, behind): runs of window starts of ``rows`` (row, text) whose window starts elsewhere too."""
    found = stash(rows.mapInArrow(lambda b: _find_anchors(b, min_bytes), ANCHORS), "anchors")
    # written, so that the join reads two plain shuffles and Spark can split the partition of a frequent gram
    often = stash(found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("often")), "shared-grams")
    shared = stash(found.join(often, F.col("gram") == F.col("often")).drop("often"), "shared-anchors")
    contexts = stash(shared.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one")), "contexts")
    per_gram = contexts.groupBy("gram").agg(F.count("*").alias("n_contexts")).where("n_contexts > 1")
    per_gram = stash(per_gram.select(F.col("gram").alias("of_gram"), F.ceil(F.col("n_contexts") / GRAM_CONTEXTS).alias("salts")), "split-grams")
    differing = contexts.join(per_gram, F.col("gram") == F.col("of_gram"))
    wanted = stash(differing.select("gram", "context", "n", "salts", "one.row", "one.place"), "wanted-contexts")
    per_row = wanted.groupBy("row").agg(F.collect_list(F.struct("gram", "context", "n", "salts", "place")).alias("wanted"))
    texts = rows.join(per_row.withColumnRenamed("row", "w_row").hint("shuffle_hash"), F.col("row") == F.col("w_row"))
    windows = F.shiftright("place", 10).bitwiseAND(F.lit(1023))
    n_bytes = wanted.agg(F.sum(windows + min_bytes)).first()[0] or 0
    shards = max(1, -(-n_bytes // SHARD_BYTES))
    cut = texts.select("text", "wanted").mapInArrow(lambda b: _cut_contexts(b, min_bytes), "gram long, context long, n long, salts long, data binary")
    dealt = cut.withColumn("shard", F.pmod("gram", F.lit(shards))).withColumn("salt", F.pmod("context", "salts"))
    out = "gram long, context long, first long, behind long, window binary"
    marked = stash(dealt.groupBy("shard", "salt").applyInPandas(lambda f: _shard(f, min_bytes), out), "shard-runs")
    local = marked.where("window is null").drop("window")
    split = marked.where("window is not null").withColumn("range", F.pmod(F.xxhash64("window"), F.lit(shards)))
    merged = split.groupBy("range").applyInPandas(lambda f: _merge(f.drop(columns="range")), "gram long, context long, first long, behind long")
    partial = local.unionByName(merged).withColumnRenamed("gram", "v_gram").withColumnRenamed("context", "v_context")
    size = F.shiftright("place", 10).bitwiseAND(F.lit(1023)) + 1
    whole = contexts.where("n > 1").select(F.col("gram").alias("v_gram"), F.col("context").alias("v_context"), F.lit(0).cast("long").alias("first"), F.lit(-1).cast("long").alias("behind"))
    verdicts = whole.unionByName(partial)
    hits = shared.join(verdicts, (F.col("gram") == F.col("v_gram")) & (F.col("context") == F.col("v_context")))
    begin = F.shiftright("place", 20)
    behind = F.when(F.col("behind") < 0, size).otherwise(F.col("behind"))
    return hits.select("row", (begin + F.col("first")).alias("first"), (begin + behind).alias("behind"))


def remove_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, spans (removed byte ranges) and kept (the remaining bytes) of every row."""
    if not GRAM <= min_bytes <= MOST_BYTES:
        raise ValueError(f"min_bytes must lie between {GRAM} and {MOST_BYTES}")
    prepare_workers(docs.sparkSession)
    text = F.coalesce(text_bytes(docs[text_col]), F.lit(b""))
    rows = docs.select(docs[id_col].cast("long").alias("id"), F.xxhash64(docs[id_col], docs[text_col]).alias("row"), text.alias("text"))
    found = repeated_windows(rows.select("row", "text"), min_bytes)
    runs = found.groupBy("row").agg(F.collect_set(F.struct("first", "behind")).alias("runs")).withColumnRenamed("row", "r_row")
    joined = rows.join(runs.hint("shuffle_hash"), F.col("row") == F.col("r_row"), "left").select("id", "text", "runs")
    return joined.mapInArrow(lambda b: _apply(b, min_bytes), "id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary")
