"""Language ID: scripts narrow the candidates, a Viterbi pass labels spans.

Training: letter trigrams (with word boundaries) of a bounded sample of labelled documents
(about ``SAMPLE_DOCS`` per language, by hash of the id) are counted in hashed buckets; the model is
a table of log probabilities per bucket and language plus the scripts each language uses.

Prediction, on whole texts: words are maximal runs of letters of one script. The script's candidates are the languages
that use it; a word's score per language is the summed log probability of its trigrams, and languages outside the
candidates are ruled out. A Viterbi pass over the words, where changing the language costs ``SWITCH_PENALTY``,
labels every word; equal neighbours form a span. The document's language is the one with most letters, its
score the share of all letters in that language's spans whose script it uses. ``like_language`` compares the mean log probability of the letters with that of the
language's own texts, so that gibberish in a known script is told from text.

Edge cases: a null text or one without a letter (Unicode category L; combining marks alone are none) is ``und`` with score 0 and no span; a script that no language uses is
labelled by its neighbours and scores nothing; without any labelled document all is ``und``; null or repeated ids are judged
row by row, and rows without an id or a language are not learned from; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import prepare_workers

#: Code point ranges of scripts; a letter in none of them belongs to script 1.
SCRIPT_RANGES = (
    ("latin", 0x41, 0x24F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x370, 0x3FF), ("cyrillic", 0x400, 0x52F), ("armenian", 0x530, 0x58F),
    ("hebrew", 0x590, 0x5FF), ("arabic", 0x600, 0x77F), ("devanagari", 0x900, 0x97F), ("bengali", 0x980, 0x9FF), ("tamil", 0xB80, 0xBFF),
    ("thai", 0xE00, 0xE7F), ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF), ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF), ("han", 0x20000, 0x323AF),
)
SCRIPTS = ("none", "other", *dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))
SAMPLE_DOCS = 2000
BUCKET_BITS = 16
SMOOTHING = 0.5
SWITCH_PENALTY = 10.0
#: A language uses a script when at least this share of its sampled letters is in it.
SCRIPT_SHARE = 0.01
_RULED_OUT = -1e4
_PIECE = 1 << 19
UNDETERMINED = "und"
#: A text is unlike its language when the mean log probability of its letters lies further below the language's own than this share of the way down to
#: that of letters never seen, and this many standard errors more.
UNLIKE_SHARE, UNLIKE_ERRORS = 0.5, 6.0
SPANS = "spans array<struct<start:int,end:int,lang:string>>"


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(script, lower-case code point, is a letter) of every code point; script 0 belongs to no word, marks belong to words but are no letters."""
    script, lower, letter = np.zeros(0x110000, np.uint8), np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
    for cp in range(0x110000):
        if 0xD800 <= cp < 0xE000:
            continue
        c = chr(cp)
        kind = unicodedata.category(c)[0]
        if kind in "LM":
            script[cp], letter[cp] = 1, kind == "L"
            if len(c.lower()) == 1:
                lower[cp] = ord(c.lower())
    for name, first, last in SCRIPT_RANGES:
        script[first:last + 1][script[first:last + 1] > 0] = SCRIPTS.index(name)
    return script, lower, letter


@dataclass
class Words:
    """Words of a piece of text: bounds, scripts, and a trigram bucket per letter with the words' first letters."""

    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    buckets: np.ndarray
    first: np.ndarray


def _opens(at: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where a new word begins: behind a gap or a change of script."""
    opens = np.ones(len(at), bool)
    opens[1:] = (at[1:] != at[:-1] + 1) | (kinds[1:] != kinds[:-1])
    return opens


def scan_words(text: str) -> Words:
    script, lower, is_letter = _tables()
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    of = script[codes]
    at = np.flatnonzero(of)
    if len(at):
        opens = _opens(at, of[at])
        worded = np.logical_or.reduceat(is_letter[codes[at]], np.flatnonzero(opens))
        at = at[worded[np.cumsum(opens) - 1]]  # marks alone are no word
    if not len(at):
        none = np.zeros(0, np.int64)
        return Words(none, none, none, none, none)
    kinds = of[at]
    opens = _opens(at, kinds)
    closes = np.append(opens[1:], True)
    letter = lower[codes[at]].astype(np.uint64)
    before = np.concatenate((letter[:1], letter[:-1]))
    before[opens] = 0
    after = np.append(letter[1:], letter[-1:])
    after[closes] = 0
    mixed = (before * np.uint64(0x9E3779B97F4A7C15) + letter) * np.uint64(0xBF58476D1CE4E5B9) + after
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    first = np.flatnonzero(opens)
    return Words(at[first], at[closes] + 1, kinds[first].astype(np.int64), (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), first)


@dataclass
class LanguageModel:
    languages: list[str]
    #: bucket x language, relative to the bucket's mean.
    scores: np.ndarray
    #: script x language: 0 for candidates, else ruled out; all 0 for scripts that nobody uses.
    candidates: np.ndarray
    supported: np.ndarray
    #: The bucket's mean log probability; with ``scores`` the log probability itself.
    level: np.ndarray
    #: Per language the mean and the spread of a letter's log probability in its own texts, and that of a letter never seen.
    usual: np.ndarray
    spread: np.ndarray
    unseen: np.ndarray


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            table = counts.setdefault(lang, np.zeros((1 << BUCKET_BITS) + len(SCRIPTS), np.int64))
            for _, piece in _pieces(text):
                words = scan_words(piece)
                table[:1 << BUCKET_BITS] += np.bincount(words.buckets, minlength=1 << BUCKET_BITS)
                np.add.at(table, (1 << BUCKET_BITS) + words.script, words.end - words.start)
    for lang, table in counts.items():
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(table[at])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> LanguageModel:
    """Learn from labelled rows of ``docs``; what is collected is bounded by buckets x languages. A row is in the sample when the hash
    of its id, as a fraction, is below sample_docs / rows of its language: no language is sorted or gathered."""
    known = docs.where(docs[lang_col].isNotNull() & docs[text_col].isNotNull() & docs[id_col].isNotNull())
    shares = known.groupBy(known[lang_col].alias("of_lang")).agg(F.least(F.lit(1.0), F.lit(float(sample_docs)) / F.count("*")).alias("part"))
    part = F.broadcast(docs.sparkSession.createDataFrame(shares.collect(), "of_lang string, part double"))
    place = F.shiftrightunsigned(F.xxhash64(known[id_col]), 11) / F.lit(float(1 << 53))
    rows = known.select(place.alias("place"), known[lang_col].alias("lang"), known[text_col].alias("text"))
    sample = rows.join(part, F.col("lang") == F.col("of_lang")).where(F.col("place") < F.col("part")).select("lang", "text")
    prepare_workers(docs.sparkSession)
    counted = sample.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).collect()
    languages = sorted({r.lang for r in counted})
    table = np.zeros(((1 << BUCKET_BITS) + len(SCRIPTS), len(languages)))
    for r in counted:
        table[r.bucket, languages.index(r.lang)] = r.n
    grams, letters = table[:1 << BUCKET_BITS], table[1 << BUCKET_BITS:]
    seen = grams.sum(axis=1) > 0
    scores = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * max(1, seen.sum())))
    level, logs = scores.mean(axis=1) if languages else np.zeros(len(scores)), scores
    scores = np.where(seen[:, None], scores - level[:, None], 0.0) if languages else scores
    share = grams / np.maximum(1, grams.sum(axis=0))
    usual = (share * logs).sum(axis=0)
    spread = np.sqrt((share * (logs - usual) ** 2).sum(axis=0))
    uses = letters >= SCRIPT_SHARE * np.maximum(1, letters.sum(axis=0))
    uses &= letters > 0
    return LanguageModel(languages, scores.astype(np.float32), np.where(uses | ~uses.any(axis=1, keepdims=True), 0, _RULED_OUT).astype(np.float32), uses,
                         level.astype(np.float32), usual, spread, logs.min(axis=0, initial=0.0))


def _pieces(text: str) -> Iterator[tuple[int, str]]:
    """(offset, piece): long texts are scanned in pieces that end behind a space where there is one."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _PIECE)
        if end < len(text):
            end = text.rfind(" ", at + _PIECE // 2, end) + 1 or end
        yield at, text[at:end]
        at = end


def viterbi(scores: np.ndarray, offsets: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of every row, for sequences ``offsets[d]:offsets[d + 1]``; one step takes all sequences along."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = offsets[:-1][order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    total = np.zeros((len(starts), scores.shape[1]), np.float32)
    back, best = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
    everyone = np.arange(len(starts))
    for t in range(steps):
        n = active[t]
        rows, now = starts[:n] + t, total[:n]
        if t:
            top = now.argmax(axis=1)
            moved = now[everyone[:n], top][:, None] - np.float32(penalty)
            back[rows], best[rows] = now < moved, top
            now = np.maximum(now, moved)
        now = now + scores[rows]
        total[:n] = now - now.max(axis=1, keepdims=True)
    label, current = np.zeros(len(scores), np.int16), total.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        rows, now = starts[:n] + t, current[:n]
        label[rows] = now
        current[:n] = np.where(back[rows, now], best[rows], now)
    return label


def label_texts(texts: list[str | None], model: LanguageModel, penalty: float = SWITCH_PENALTY) -> tuple[list, np.ndarray, pa.ListArray, np.ndarray]:
    """(language, score, spans, whether the letters are as probable as the language's own) of every text."""
    starts, ends, scripts, scores, levels, counts = [], [], [], [], [], np.zeros(len(texts), np.int64)
    for d, text in enumerate(texts):
        for offset, piece in _pieces(text or ""):
            words = scan_words(piece)
            if len(words.start):
                counts[d] += len(words.start)
                starts.append(words.start + offset), ends.append(words.end + offset), scripts.append(words.script)
                scores.append(np.add.reduceat(model.scores[words.buckets], words.first, axis=0))
                levels.append(np.add.reduceat(model.level[words.buckets], words.first))
    languages, k = model.languages, len(model.languages)
    if not k or not starts:
        empty = pa.ListArray.from_arrays(np.zeros(len(texts) + 1, np.int32), _spans([], [], [], languages))
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), empty, np.zeros(len(texts), bool)
    start, end, script = np.concatenate(starts), np.concatenate(ends), np.concatenate(scripts)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    score_of = np.concatenate(scores)
    label = viterbi(score_of + model.candidates[script], offsets, penalty).astype(np.int64)
    doc = np.repeat(np.arange(len(texts)), counts)
    letters = (end - start).astype(float)
    backed = np.bincount(doc * k + label, letters * model.supported[script, label], len(texts) * k).reshape(-1, k)
    labelled = np.bincount(doc * k + label, letters, len(texts) * k).reshape(-1, k)
    best, everyone = labelled.argmax(axis=1), np.arange(len(texts))
    score = np.divide(backed[everyone, best], labelled.sum(axis=1), out=np.zeros(len(texts)), where=labelled.sum(axis=1) > 0)
    cutoff = model.usual - UNLIKE_SHARE * (model.usual - model.unseen)
    above = score_of[np.arange(len(label)), label] + np.concatenate(levels) - letters * cutoff[label]
    length = np.bincount(doc, letters, len(texts))
    spread = np.sqrt(np.bincount(doc, letters * model.spread[label] ** 2, len(texts)))
    like = (length > 0) & (np.bincount(doc, above, len(texts)) >= -UNLIKE_ERRORS * spread)
    changes = np.ones(len(doc), bool)
    changes[1:] = (doc[1:] != doc[:-1]) | (label[1:] != label[:-1])
    opens, closes = np.flatnonzero(changes), np.append(np.flatnonzero(changes)[1:], len(doc)) - 1
    span_offsets = np.concatenate(([0], np.cumsum(np.bincount(doc[opens], minlength=len(texts))))).astype(np.int32)
    spans = pa.ListArray.from_arrays(span_offsets, _spans(start[opens], end[closes], label[opens], languages))
    return [languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), counts.tolist())], score, spans, like


def _spans(start, end, label, languages: list[str]) -> pa.StructArray:
    names = pa.array(languages, pa.string()).take(pa.array(label, pa.int64()))
    return pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(end, pa.int32()), names], names=["start", "end", "lang"])


def label_languages(rows: DataFrame, model: LanguageModel, text_col: str = "text", penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``row`` (a struct of all input columns), lang_pred, lang_score, like_language and spans (code point offsets)."""
    spark = rows.sparkSession
    prepare_workers(spark)
    shared = spark.sparkContext.broadcast(model)
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = batch.column(0)
            lang, score, spans, like = label_texts(row.field(text_col).to_pylist(), shared.value, penalty)
            yield pa.RecordBatch.from_arrays([row, pa.array(lang, pa.string()), pa.array(score), pa.array(like), spans],
                                             names=["row", "lang_pred", "lang_score", "like_language", "spans"])

    found = T.StructType.fromDDL(f"lang_pred string, lang_score double, like_language boolean, {SPANS}")
    return packed.mapInArrow(run, T.StructType([*packed.schema.fields, *found.fields]))


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id as text has remainder 1 by 3."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    return train(docs.where(~held_out(docs[id_col])), id_col, text_col, lang_col)
