"""Spelling variant grouping: words one edit apart, found by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point turns one into the other, which holds exactly when
their common prefix and common suffix together reach the longer length minus one. Tiles compare blocks of words densely: code points go into two
matrices padded at the end (prefixes) and at the start (suffixes), block by block, and both lengths of every pair come from one comparison each.

Which tiles exist: with m the longer length minus one, two near words share their first m // 2 code points or, if they do not, their last m - m // 2. Words
are grouped by these halves (once as the longer, once as the shorter word of a pair), sorted by group, and only tiles that
share a group are compared; a pair counts in its prefix group if the prefix is shared and else in its suffix group, so exactly once. That cut is exact.
Small groups are dealt over tasks by hash; a group of more than ``GROUP_ROWS`` words is cut into blocks by hash, and every pair of its blocks is a task of its own, so no group
is gathered anywhere. A task returns, for each word, the number of near words it saw and the best of them, never pairs.

A word's form is its near word of largest count (ties: the smaller in code-point order) if that is at least ``ratio`` times the word's own;
roots follow forms to their end by pointer jumping, whose rounds are bounded because counts at least double (``ratio`` > 1) along a chain.

Edge cases: null texts have no words; words of any length are compared (tiles get fewer rows as words get longer); equal counts are broken by
code-point order; repeated rows count again; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import checked_broadcast, lower_az, prepare_workers, stash

LETTERS = r"[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 5
MIN_COUNT = 3
RATIO = 2
#: Rows of a group that one task compares; larger groups are cut into blocks.
GROUP_ROWS = 4096
#: Rows of small groups that go to one task.
TASK_ROWS = 20_000
_TILE = 128
_CELLS = 1 << 21
_LINKS = 1 << 20
_MAX_HOT = 100_000
BEST = "word string, n_near long, best_n long, best string"
_NOTHING = pd.DataFrame({"word": [], "n_near": np.zeros(0, np.int64), "best_n": np.zeros(0, np.int64), "best": []})


def words_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, word): every maximal run of letters of every text, A-Z lower-cased."""
    found = F.regexp_extract_all(lower_az(docs[text_col]), F.lit(LETTERS), F.lit(0))
    return docs.select(docs[id_col].alias("id"), F.explode(found).alias("word"))


def count_words(words: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` code points found at least ``min_count`` times."""
    long = words.where(F.char_length("word") >= min_length)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def _half_groups(counts: DataFrame) -> DataFrame:
    """Every word in its four groups: as longer and as shorter word of a pair, by prefix and by suffix."""
    length = F.char_length("word")
    roles = F.array(F.struct(F.lit(True).alias("longer"), (length - 1).alias("m")), F.struct(F.lit(False).alias("longer"), length.alias("m")))
    rows = counts.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.longer", "r.m")
    half = F.floor(F.col("m") / 2).cast("int")
    prefix = F.struct(F.lit(True).alias("prefix"), F.left("word", half).alias("part"))
    suffix = F.struct(F.lit(False).alias("prefix"), F.right("word", F.col("m") - half).alias("part"))
    halves = rows.withColumn("h", F.explode(F.array(prefix, suffix)))
    return halves.select(F.xxhash64("m", "h.prefix", "h.part").alias("group"), "word", "n", "longer", "m", F.col("h.prefix").alias("prefix"))


def _dealt(rows: DataFrame, group_rows: int, task_rows: int) -> DataFrame:
    """Rows with the task that compares them, the row's block in a group that is cut (else -1), and whether the task compares two blocks or the rows of one."""
    spark = rows.sparkSession
    sizes = rows.groupBy("group").count()
    total, cut = sizes.agg(F.sum("count"), F.count_if(F.col("count") > group_rows)).first()
    tasks = max(1, -(-(total or 0) // task_rows))
    whole = rows
    if cut:
        hot = checked_broadcast(sizes.where(F.col("count") > group_rows).select("group", F.ceil(F.col("count") * 2 / group_rows).cast("int").alias("blocks")), _MAX_HOT)
        whole = rows.join(hot, "group", "left_anti")
        block = F.pmod(F.xxhash64("word", F.lit(1)), F.col("blocks")).cast("int")
        large = rows.join(hot, "group").withColumn("block", block).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        large = large.select(*rows.columns, "block", (F.col("block") != F.col("mate")).alias("across"), F.struct("group", F.least("block", "mate").alias("a"), F.greatest("block", "mate").alias("b")).alias("task"))
    no_pair = F.lit(-1).cast("int")
    small = whole.select(*rows.columns, no_pair.alias("block"), F.lit(False).alias("across"), F.struct(F.pmod("group", F.lit(tasks)).alias("group"), no_pair.alias("a"), no_pair.alias("b")).alias("task"))
    return small.unionByName(large) if cut else small


def _tiles(lengths: np.ndarray) -> list[tuple[int, int]]:
    """Consecutive rows, at most ``_TILE`` and fewer for long words, so that a pair of tiles stays within ``_CELLS``."""
    out, first = [], 0
    while first < len(lengths):
        last, widest = first, 0
        while last < len(lengths) and last - first < _TILE:
            widest = max(widest, int(lengths[last]))
            if last > first and (last - first + 1) ** 2 * (widest + 1) > _CELLS:
                break
            last += 1
        out.append((first, last))
        first = last
    return out


def _matrices(words: list[str], width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words from the left and, reversed, from the right, padded behind with ``pad``."""
    ahead, back = np.full((len(words), width), pad, np.int32), np.full((len(words), width), pad, np.int32)
    for k, word in enumerate(words):
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), "<i4")
        ahead[k, :len(points)], back[k, :len(points)] = points, points[::-1]
    return ahead, back


def shared_ends(a: list[str], b: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the common prefix and the common suffix of every word of one block with every word of another."""
    width = max(map(len, a + b)) + 1
    left, right = _matrices(a, width, -1), _matrices(b, width, -2)  # paddings differ, so that every comparison ends
    return tuple((x[:, None, :] != y[None, :, :]).argmax(axis=2) for x, y in zip(left, right))


def _near_in_tile(rows: pd.DataFrame, words: list[str], a: tuple[int, int], b: tuple[int, int], across: bool) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs (row, row) between two tiles of the sorted rows, each once."""
    i, j = slice(*a), slice(*b)
    group, m, longer, prefix = (rows[c].to_numpy() for c in ("group", "m", "longer", "prefix"))
    asked = (group[i, None] == group[None, j]) & (m[i, None] == m[None, j]) & (prefix[i, None] == prefix[None, j]) & (longer[i, None] | longer[None, j])
    if a == b:
        asked &= np.arange(*a)[:, None] < np.arange(*b)[None, :]
    if across:
        block = rows["block"].to_numpy()
        asked &= block[i, None] != block[None, j]
    if not asked.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ahead, back = shared_ends(words[i], words[j])
    halves = ahead >= m[i, None] // 2
    near = asked & (ahead + back >= m[i, None]) & (halves == prefix[i, None])
    x, y = np.nonzero(near)
    return x + a[0], y + b[0]


def _best(words: list[str], counts: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    """Number of near words and the best of them for each word of the pairs."""
    one, two = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    me, other = np.concatenate((one, two)), np.concatenate((two, one))
    order_of = {w: k for k, w in enumerate(sorted({words[k] for k in np.unique(other).tolist()}))}
    place = np.array([order_of.get(w, -1) for w in words], np.int64)
    by = np.lexsort((place[other], -counts[other], me))
    me, other = me[by], other[by]
    heads = np.flatnonzero(np.concatenate(([True], me[1:] != me[:-1])))
    best = other[heads]
    return pd.DataFrame({"word": [words[k] for k in me[heads].tolist()], "n_near": np.diff(np.append(heads, len(me))),
                         "best_n": counts[best], "best": [words[k] for k in best.tolist()]})


def _compare(frame: pd.DataFrame) -> pd.DataFrame:
    """The near words among the rows of one task: groups sorted end to end, tiles along the diagonal."""
    rows = frame.sort_values(["m", "group", "word"], kind="stable", ignore_index=True)
    across = bool(rows["across"].iloc[0])
    words, counts, group = rows["word"].tolist(), rows["n"].to_numpy(), rows["group"].to_numpy()
    tiles = _tiles(rows["m"].to_numpy() + 1)
    out, pairs, held = [], [], 0
    for k, a in enumerate(tiles):
        for b in tiles[k:]:
            if group[a[1] - 1] != group[b[0]] and a != b:
                break
            found = _near_in_tile(rows, words, a, b, across)
            if len(found[0]):
                pairs.append(found)
                held += len(found[0])
            if held > _LINKS:
                out.append(_best(words, counts, pairs))
                pairs, held = [], 0
    if pairs:
        out.append(_best(words, counts, pairs))
    return pd.concat(out or [_NOTHING]).astype({"word": object, "best": object})


def near_words(counts: DataFrame, group_rows: int = GROUP_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """word, n_near, best_n, best (the near word of largest count) of every word of ``counts`` (word, n) that has a near word."""
    prepare_workers(counts.sparkSession)
    rows = stash(_half_groups(counts), "spelling-halves")
    seen = _dealt(rows, group_rows, task_rows).groupBy("task").applyInPandas(lambda _, frame: _compare(frame), BEST)
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    found = seen.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
    return found.select("word", "n_near", (-F.col("b.less")).alias("best_n"), F.col("b.word").alias("best"))


def _roots(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form), by pointer jumping."""
    now = stash(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    for _ in range(rounds):
        onward = now.select(F.col("word").alias("at"), F.col("root").alias("further"))
        now = stash(now.join(onward, F.col("root") == F.col("at"), "left").select("word", F.coalesce("further", "root").alias("root")), "spelling-roots")
    return now


def variant_groups(counts: DataFrame, ratio: int = RATIO, group_rows: int = GROUP_ROWS, task_rows: int = TASK_ROWS) -> DataFrame:
    """word, n, n_near, form, form_n and root of every row of ``counts`` (word, n; words distinct)."""
    if ratio < 2:
        raise ValueError("a form must be at least twice as frequent")
    counts = stash(counts.select("word", "n"), "spelling-counts")
    near = near_words(counts, group_rows, task_rows)
    taken: Column = F.col("best_n") >= ratio * F.col("n")
    joined = counts.join(near, "word", "left")
    judged = stash(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(taken, F.col("best")).alias("form"),
                                 F.when(taken, F.col("best_n")).alias("form_n")), "spelling-forms")
    least, most = judged.agg(F.min("n"), F.max("n")).first()
    steps = int(math.log(most / least, ratio)) + 1 if least else 0  # the longest chain of forms
    roots = _roots(judged.where("form is not null"), max(0, steps - 1).bit_length())
    return judged.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
