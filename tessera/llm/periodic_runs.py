"""Periodic run detection: sparse diagonal matching of every text against itself.

A run is a maximal stretch of words with smallest period q (words q apart are equal) of at least ``min_length`` words and
``min_periods`` periods. A diagonal is a lag q; its match length grows by one with every word whose context also ended
q words earlier, and a diagonal that stops growing emits its stretch if that is long enough.

Earlier occurrences of single words would make the table quadratic, so words are replaced by their contexts of k = 16, 32,
64, ... words, and only the nearest earlier occurrence of a context moves a diagonal. Both cuts are exact: inside a run of smallest
period q <= k a context of k words cannot recur before q words (the run's root would be a power of a shorter word), so the
nearest occurrence is q back for every word of the run; and for k / 2 < q <= k a run of three periods has at least one such
context. A diagonal that is no run in this sense (its lag also matches beyond its ends, or a shorter lag matches there) is dropped. Contexts are ranked
exactly, by doubling (a context of 2k words is a pair of contexts of k words), and a context that occurs once in its document leaves
the table, so that a plain text costs two or three sorts and a text of n words never more than log n of them.

Edge cases: null and empty texts have no words, no runs and an empty collapsed text; texts are read in pieces of
``PIECE_BYTES``, whatever their length; repeated rows are judged alike; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare_workers, text_bytes

MIN_LENGTH = 24
MIN_PERIODS = 3
PIECE_BYTES = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
RUN = "struct<start: bigint, length: bigint, period: bigint>"
RUNS = f"id long, n_words long, runs array<{RUN}>, collapsed binary"


def pieces_of(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``PIECE_BYTES``."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + PIECE_BYTES) if len(text) - start > PIECE_BYTES else None
        end = space.start() if space else len(text)
        yield text[start:end].split()
        start = end + 1


def number_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all texts in one row, each text between two separators that equal nothing; and the texts' first places."""
    numbers: dict[bytes, int] = {}
    parts, starts, place = [np.zeros(1, np.int64)], [], 1
    for text in texts:
        starts.append(place)
        for words in pieces_of(text):
            parts.append(np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words)))
            place += len(words)
        parts.append(np.zeros(1, np.int64))
        place += 1
    row = np.concatenate(parts)
    separators = np.flatnonzero(row == 0)
    row[separators] = len(numbers) + 1 + np.arange(len(separators))
    return row, np.array(starts, np.int64)


def _smallest_context(min_length: int, min_periods: int) -> int:
    """The largest power of two that every run's matches on its diagonal reach."""
    if min_periods < 3 or min_length < 2:
        raise ValueError("runs need at least three periods and two words")
    return 1 << max(0, (min_length * (min_periods - 1) // min_periods).bit_length() - 1)


def _diagonals(row: np.ndarray, text_of: np.ndarray, first: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each context length k from ``first``: the places whose context occurred before in the text, and the nearest lag."""
    n, k = len(row), 1
    rank, at, key = np.full(n, -1, np.int64), np.arange(n), row
    while len(at):
        order = np.argsort(key, kind="stable")
        by, places = key[order], at[order]
        again = np.zeros(len(at) + 1, bool)
        again[1:-1] = (by[1:] == by[:-1]) & (text_of[places[1:]] == text_of[places[:-1]])
        repeats = again[:-1] | again[1:]
        if k >= first:
            lag = np.zeros(n, np.int64)
            later = np.flatnonzero(again[:-1])
            lag[places[later]] = places[later] - places[later - 1]
            found = np.flatnonzero(lag)
            yield k, found, lag[found]
        rank[:] = -1
        rank[places[repeats]] = np.cumsum(~again[:-1])[repeats]
        both = np.flatnonzero(rank[k:] >= 0) + k
        at = both[rank[both - k] >= 0]
        key = rank[at - k] * (n + 1) + rank[at]
        k *= 2


def runs_of(row: np.ndarray, starts: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> np.ndarray:
    """(place, length, period) of every run, by place, then period."""
    first = _smallest_context(min_length, min_periods)
    text_of = np.searchsorted(starts, np.arange(len(row)), "right")
    out = [np.zeros((0, 3), np.int64)]
    for k, places, lags in _diagonals(row, text_of, first):
        near = (lags <= k) & ((lags > k // 2) | (k == first))
        places, lags = places[near], lags[near]
        if not len(places):
            continue
        heads = np.flatnonzero(np.concatenate(([True], (np.diff(places) != 1) | (np.diff(lags) != 0))))
        ends = np.concatenate((heads[1:], [len(places)])) - 1
        period = lags[heads]
        begin, end = places[heads] - k + 1 - period, places[ends] + 1
        length = end - begin
        long = length >= np.maximum(min_length, min_periods * period)
        begin, end, period, length = begin[long], end[long], period[long], length[long]
        maximal = (row[begin - 1] != row[begin - 1 + period]) & (row[end] != row[end - period])
        out.append(np.stack((begin, length, period), axis=1)[maximal])
    found = np.concatenate(out)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def collapse(text: bytes, runs: np.ndarray) -> bytes:
    """The words outside runs and in the first period of every run that holds them, joined by one space."""
    if not len(runs):
        return b" ".join(text.split()) if len(text) <= PIECE_BYTES else b" ".join(b" ".join(p) for p in pieces_of(text) if p)
    drop = np.zeros(int((runs[:, 0] + runs[:, 1]).max()) + 1, np.int32)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    dropped = np.cumsum(drop) > 0
    out, place = [], 0
    for words in pieces_of(text):
        gone = dropped[place:place + len(words)]
        kept = [w for w, g in zip(words, gone.tolist()) if not g] + words[len(gone):]
        if kept:
            out.append(b" ".join(kept))
        place += len(words)
    return b" ".join(out)


def _find(batches: Iterator[pa.RecordBatch], min_length: int, min_periods: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").to_pylist()]
        row, starts = number_words(texts)
        runs = runs_of(row, starts, min_length, min_periods)
        text_of = np.searchsorted(starts, runs[:, 0], "right") - 1
        runs[:, 0] -= starts[text_of]
        cuts = np.searchsorted(text_of, np.arange(len(texts) + 1))
        collapsed = [collapse(t, runs[i:j]) for t, i, j in zip(texts, cuts[:-1], cuts[1:])]
        sizes = np.diff(np.concatenate((starts, [len(row)]))) - 1
        values = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(runs[:, c])) for c in range(3)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), values),
                                          pa.array(collapsed, pa.binary())], names=["id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, runs (start, length, period in words; by start, then period) and collapsed (the text with every run reduced to
    its first period, words joined by one space) of every row."""
    _smallest_context(min_length, min_periods)
    prepare_workers(docs.sparkSession)
    rows = docs.select(docs[id_col].cast("long").alias("id"), text_bytes(docs[text_col]).alias("text"))
    found = rows.mapInArrow(lambda batches: _find(batches, min_length, min_periods), RUNS)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period, compared exactly; ties go to the smallest start, then period. Null without runs."""
    def better(best: Column, run: Column) -> Column:
        more = best.isNull() | (run["length"] * best["period"] > best["length"] * run["period"])
        return F.when(more, run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def written(runs: Column) -> Column:
    """One line ``start,length,period`` for every run."""
    return F.concat_ws("", F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
