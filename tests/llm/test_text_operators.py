"""Language ID, SimHash, decontamination, quality and suffix dedup against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import decontaminate, language_id, quality, simhash, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, H string, fp string"


def frame(spark, texts, source=None, lang=None, ids=None):
    """Documents with extra columns whose names the operators use inside."""
    ids = ids or list(range(len(texts)))
    rows = [(i, t, lang[k] if lang else "en", source[k] if source else "a", 0, "x", -1, "y", "z") for k, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x" for _ in range(n))


# ---------------------------------------------------------------- language ID

SYLLABLES = {"en": ["th", "er", "ing", "on", "wh"], "fr": ["eau", "oui", "que", "é", "ment"], "ru": ["ств", "про", "ова", "ни", "ко"]}


def speak(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(3)
    langs = [lang for lang in SYLLABLES for _ in range(30)]
    docs = frame(spark, [speak(rng, lang, 60) for lang in langs], lang=langs)
    return language_id.identify(docs)


def test_language_of_pure_and_mixed_texts(model):
    rng = random.Random(4)
    fr, en, ru = speak(rng, "fr", 30), speak(rng, "en", 50), speak(rng, "ru", 10)
    lang, score, spans, _ = language_id.label_texts([fr, en, f"{fr} {en} {ru}", None, "", "12 !!", "漢字 漢字"], model)
    assert lang[:6] == ["fr", "en", "en", "und", "und", "und"]
    assert score[0] == score[1] == 1 and score[6] == 0 and (score[3:6] == 0).all()
    text = f"{fr} {en} {ru}"
    mixed = spans.to_pylist()[2]
    assert [s["lang"] for s in mixed] == ["fr", "en", "ru"]
    assert text[mixed[2]["start"]:mixed[2]["end"]] == ru  # scripts leave one candidate
    assert abs(mixed[1]["start"] - len(fr) - 1) < 30


def test_marks_without_a_letter_are_no_text(model):
    lang, score, spans, like = language_id.label_texts(["\u0301 \u0300\u0308", "e\u0301lan \u0301", "\u0301" * 9], model)
    assert lang[0] == lang[2] == "und" and lang[1] != "und" and score[0] == score[2] == 0 and spans.to_pylist()[0] == []


def test_gibberish_is_unlike_every_language(model):
    rng = random.Random(12)
    letters = "bcdfghjklmnpqrstvwxz"
    gibberish = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 9))) for _ in range(n)) for n in (12, 40, 400)]
    plain = [speak(rng, lang, n) for lang in SYLLABLES for n in (1, 5, 40, 400)]
    mixed = speak(rng, "fr", 30) + " " + speak(rng, "ru", 30)
    _, _, _, like = language_id.label_texts([*gibberish, *plain, mixed, None, "12"], model)
    assert like.tolist() == [False] * 3 + [True] * (len(plain) + 1) + [False] * 2


def test_viterbi_is_optimal():
    import numpy as np

    rng = np.random.default_rng(1)
    scores = rng.normal(0, 3, (9, 3)).astype(np.float32)
    offsets = np.array([0, 5, 5, 9])
    got = language_id.viterbi(scores, offsets, 2.0)

    def value(labels, a):
        return sum(scores[a + t, x] for t, x in enumerate(labels)) - 2 * sum(x != y for x, y in zip(labels, labels[1:]))

    from itertools import product
    for a, b in ((0, 5), (5, 9)):
        best = max(value(x, a) for x in product(range(3), repeat=b - a))
        assert value(got[a:b].tolist(), a) == pytest.approx(best, abs=1e-4)


def test_language_rows_pass_through(spark, model):
    docs = frame(spark, ["the thing whoner", None, "the thing whoner"], ids=[1, None, 1])
    out = language_id.label_languages(docs, model).select("row.*", "lang_pred").collect()
    assert len(out) == 3 and sorted(str(r.doc_id) for r in out) == ["1", "1", "None"] and all(r.H == "y" for r in out)
    empty = docs.limit(0)
    assert language_id.label_languages(empty, language_id.identify(empty)).count() == 0
    assert language_id.label_languages(docs, language_id.identify(empty)).select("lang_pred").distinct().collect()[0][0] == "und"


def test_long_text_is_scanned_whole(model):
    rng = random.Random(5)
    text = speak(rng, "en", 3000) * 120 + " " + speak(rng, "ru", 40)
    assert len(text) > language_id._PIECE
    _, _, spans, _ = language_id.label_texts([text], model)
    assert spans.to_pylist()[0][-1]["end"] == len(text) and spans.to_pylist()[0][-1]["lang"] == "ru"


# ---------------------------------------------------------------- SimHash

def brute_fingerprint(text, shingle=3):
    ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not ws:
        return 0
    grams = [" ".join(ws[i:i + shingle]) for i in range(max(1, len(ws) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(points, max_bits):
    label = {p: p for p in points}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for a, b in combinations(points, 2):
        if (a ^ b).bit_count() <= max_bits:
            x, y = sorted((root(a), root(b)))
            label[y] = x
    return {p: root(p) for p in points}


def test_simhash_against_brute_force(spark):
    rng = random.Random(6)
    texts = [None, "", " \t", "one", "Two Words", "ÉA b c", words(rng, 200_0)]
    for _ in range(40):
        base = words(rng, rng.randint(40, 400)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            near = list(base)
            near[rng.randrange(len(near))] = "changed"
            texts.append(" ".join(near))
    texts += [texts[9]] * 30
    ids = [None, *range(1000, 1000 + len(texts) - 1)]
    want_fp = [brute_fingerprint(t) for t in texts]
    component = brute_components(sorted(set(want_fp)), 2)
    least = defaultdict(list)
    for i, fp in zip(ids, want_fp):
        least[component[fp]].append(i)
    want = Counter((i, f"{fp:016x}", min((x for x in least[component[fp]] if x is not None), default=None)) for i, fp in zip(ids, want_fp))
    docs = frame(spark, texts, ids=ids)
    got = simhash.near_duplicates(docs).select("id", simhash.hex_fingerprint(F.col("fp")), "component_id").collect()
    assert Counter(map(tuple, got)) == want
    stay = simhash.one_of_each(docs)
    assert stay.columns == docs.columns and stay.count() == len(least)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["random", "dense"])
def test_vantage_point_tree_finds_all_links(kind):
    import numpy as np

    rng = np.random.default_rng(8)
    seeds = rng.integers(0, 1 << 63, 300 if kind == "random" else 3, dtype=np.uint64)
    points = set(seeds.tolist())
    for s in seeds.tolist():
        for _ in range(4 if kind == "random" else 500):
            for b in rng.integers(0, 64, rng.integers(1, 4)).tolist():
                s ^= 1 << b
            points.add(s)
    points = np.array(sorted(points), np.uint64)
    tree = simhash.routing_tree(points[::3], 8)
    shard, routed, home = simhash._route(tree, points, 2)
    assert home.sum() == len(points)
    label = {int(p): int(p) for p in points}

    def root(p):
        while label[p] != p:
            p = label[p]
        return p

    for s in set(shard.tolist()):
        at = shard == s
        u, v = simhash.shard_links(np.concatenate([routed[at & home], routed[at & ~home]]), int((at & home).sum()), 2)
        for a, b in zip(u.tolist(), v.tolist()):
            x, y = sorted((root(a), root(b)))
            label[y] = x
    assert {int(p): root(int(p)) for p in points} == brute_components(points.tolist(), 2)


def test_components_of_a_long_chain(spark):
    from tessera.llm.components import connected_components

    edges = [(k, k + 1) for k in range(100)] + [(500, 501), (502, 501), (7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(101)} | {k: 500 for k in (500, 501, 502)}


# ---------------------------------------------------------------- decontamination

def test_masks_meet_every_window_with_two_substitutions():
    for gone in combinations(range(decontaminate.WINDOW), 2):
        assert any(not set(gone) & {s + k for k in mask} for mask in decontaminate.MASKS for s in range(decontaminate.WINDOW - mask[-1]))


def brute_contaminated(text, items):
    doc = decontaminate.words_of(text or "")
    found = set()
    for item_id, item in items:
        item = decontaminate.words_of(item or "")
        w = min(13, len(item))
        need = math.ceil(0.8 * w)
        for p in range(len(doc) - w + 1):
            if w >= 5 and any(sum(a == b for a, b in zip(doc[p:p + w], item[q:q + w])) >= need for q in range(len(item) - w + 1)):
                found.add(item_id)
                break
    return sorted(found)


def test_decontamination_against_brute_force(spark):
    rng = random.Random(9)
    items = [(k, words(rng, rng.choice([3, 8, 12, 13, 20, 50]), 60)) for k in range(25)] + [(90, None), (91, ""), (92, "...")]
    texts = [None, "", "short"]
    for k in range(150):
        item = rng.choice(items[:25])[1].split()
        for _ in range(rng.randint(0, 6)):
            item[rng.randrange(len(item))] = "other"
        cut = item[rng.randint(0, 4):]
        text = words(rng, rng.randint(0, 40), 60) + " " + ", ".join(cut).upper() + ". " + words(rng, rng.randint(0, 300), 60)
        texts.append(text)
    docs = frame(spark, texts + texts[3:5], ids=[*range(len(texts)), 3, 3])
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, text_hash int")
    want = Counter((i, tuple(brute_contaminated(t, items))) for i, t in zip([*range(len(texts)), 3, 3], texts + texts[3:5]))
    for block_words in (decontaminate.BLOCK_WORDS, 100):
        got = decontaminate.mark_documents(docs, bench, block_words=block_words).collect()
        assert Counter((r.id, tuple(r["items"])) for r in got) == want
        assert all(r.contaminated == bool(r["items"]) == (r.overlap_words > 0) for r in got)
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(n for (_, f), n in want.items() if not f)
    assert decontaminate.clean_documents(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.mark_documents(docs.limit(0), bench).count() == 0


def brute_overlaps(text, items):
    doc, out = decontaminate.words_of(text or ""), set()
    for item_id, item in items:
        item = decontaminate.words_of(item)
        w = min(13, len(item))
        need = math.ceil(0.8 * w)
        for d in range(-len(item), len(doc) if w >= 5 else -len(item)):
            good = [p for p in range(max(0, d), min(len(doc), d + len(item)) - w + 1) if sum(doc[p + k] == item[p + k - d] for k in range(w)) >= need]
            at = sorted({p + k for p in good for k in range(w)})
            heads = [x for x in at if x - 1 not in at]
            for first in heads:
                last = next(x for x in range(first, len(doc) + 1) if x not in at)
                out.add((item_id, first, last - first, sum(doc[x] == item[x - d] for x in range(first, last))))
    return out


def test_short_items_are_met_with_every_allowed_substitution():
    for n in range(decontaminate.SHORTEST, decontaminate.WINDOW):
        pieces = decontaminate.short_pieces(n)
        assert [o for o, _ in pieces] == [sum(m for _, m in pieces[:k]) for k in range(len(pieces))] and sum(m for _, m in pieces) == n
        for gone in combinations(range(n), n - math.ceil(0.8 * n)):
            assert any(not set(gone) & set(range(o, o + m)) for o, m in pieces)


def test_overlaps_end_at_gaps_and_short_items(spark):
    item = " ".join(f"i{k}" for k in range(200))
    far = " ".join([*(f"i{k}" for k in range(13)), *(f"x{k}" for k in range(174)), *(f"i{k}" for k in range(187, 200))])
    items = [(1, item), (2, "a b c d"), (3, "yes"), (4, "one two three four five six seven eight nine ten eleven twelve"), (5, "red green blue black white")]
    texts = [far, "yes a b c d yes", "so one two three FOUR five other seven eight nine else eleven twelve end", "one two three x five y seven z nine ten eleven twelve",
             "red green, x black white", "red x y black white"]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_overlaps(frame(spark, texts), bench).collect()
    got = {(r["id"], r["item_id"], r["first_word"], r["n_words"], r["n_equal"]) for r in found}
    assert got == {(0, 1, 0, 15, 13), (0, 1, 185, 15, 13), (2, 4, 1, 12, 10), (4, 5, 0, 5, 4)}
    assert len(found) == 4


def test_every_stage_of_the_pipeline_takes_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    names = ["f_id", "f_hash", "id", "item_id", "text_hash", "row", "rid", "host", "h", "fp", "component_id", "of_lang", "part", "lang_pred", "size", "slot"]
    rng = random.Random(3)
    rows = [(i, speak(rng, "en", 60), "en", "s", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.select("*", *[F.lit(str(k)).alias(n) for k, n in enumerate(names)])
    spark.createDataFrame([(1, rows[3][1])], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert out.where("f_id = '0' AND slot = '15'").count() == out.count() > 20
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() > 0


def test_benchmark_stays_off_the_driver(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    monkeypatch.setattr(decontaminate, "HOT_SEEDS", 20, raising=False)  # several salts
    rng = random.Random(19)
    items = [(k, words(rng, rng.choice([5, 13, 30, 200]), 60)) for k in range(12)]
    texts = [None, "", items[3][1]]
    for _ in range(60):
        item = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, 3)):
            item[rng.randrange(len(item))] = "other"
        texts.append(words(rng, rng.randint(0, 90), 60) + " " + " ".join(item[rng.randint(0, 2):]) + " " + words(rng, rng.randint(0, 90), 60))
    bench = spark.createDataFrame(items + [items[3]] * 500, "item_id long, text string").repartition(3)
    fetched = []

    def collect(self, f=DataFrame.collect):
        fetched.append(self.columns)
        return f(self)

    with monkeypatch.context() as patch:
        patch.setattr(DataFrame, "collect", collect)
        found = decontaminate.find_overlaps(frame(spark, texts), bench)
    assert not any("text" in columns for columns in fetched)
    got = found.select("id", "item_id", "first_word", "n_words", "n_equal").collect()
    assert Counter(map(tuple, got)) == Counter((i, *x) for i, t in enumerate(texts) for x in brute_overlaps(t, items))


# ---------------------------------------------------------------- quality

def brute_repeats(ws):
    windows = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    return len({i + k for i in range(len(ws) - 2) if windows[tuple(ws[i:i + 3])] > 1 for k in range(3)})


def test_quality_against_brute_force(spark):
    rng = random.Random(11)
    texts, sources = [None, "", "# a $", "a b c a b c\n\n \na b"], [None, "s", "s", "s"]
    for k in range(120):
        lines = [words(rng, rng.randint(1, 12), 30) for _ in range(rng.randint(1, 12))]
        if k % 3 == 0:
            lines += ["Common  Line of every document here", "common line of\tevery document here "] * rng.randint(1, 3)
        if k % 5 == 0:
            lines = ["common line of every document here " + " ".join(f"n{x}" for x in range(60)), "and its own end"]
        texts.append("\n".join(lines) + rng.choice(["", "\n", " é#"]))
        sources.append(rng.choice(["s", "s", "t", None]))
    ids = list(range(len(texts)))
    hosts, docs_of = Counter(sources), defaultdict(set)

    def keys(t):
        return [(" ".join(WORD.findall(x)).translate({c: c + 32 for c in range(65, 91)}), len(WORD.findall(x))) for x in (t or "").split("\n") if WORD.findall(x)]

    for i, t, s in zip(ids, texts, sources):
        for key, _ in keys(t):
            docs_of[s, key].add(i)
    want = set()
    for i, t, s in zip(ids, texts, sources):
        ws = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.findall(x)]
        removed = sum(n for key, n in keys(t) if len(docs_of[s, key]) > max(5, 0.01 * hosts[s]))
        rep = brute_repeats(ws)
        failed = len(ws) < 50 or 100 * rep > 50 * len(ws)
        want.add((i, len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), rep, removed, failed, not failed and len(ws) - removed >= 0.5 * len(ws)))
    docs = frame(spark, texts, source=sources)
    judged = quality.judge_documents(quality.document_stats(docs), min_docs=5)
    got = judged.select("id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_removed_words", "base_failed", "kept")
    assert {tuple(r) for r in got.collect()} == want
    assert {w[-1] for w in want} == {True, False} and any(w[-1] is False and w[-2] is False for w in want)
    assert quality.judge_documents(quality.document_stats(docs.limit(0))).count() == 0
    row = judged.where("id = 4").first()
    left = quality.without_lines(texts[4].encode(), row.removed_lines or []).decode()
    assert len(WORD.findall(left)) == row.n_words - row.n_removed_words


def test_repeated_rows_do_not_change_line_frequency(spark):
    line = "this line stands in thirty documents of the host and is removed"
    body = [" ".join(f"u{i}x{k}" for k in range(55)) for i in range(31)]
    docs = frame(spark, [f"{b}\n{line}" for b in body[:30]] + [body[30]] * 3000, ids=[*range(30), *[99] * 3000])
    judged = quality.judge_documents(quality.document_stats(docs))
    assert judged.where("n_removed_words > 0").count() == 30


def test_repeated_words_of_a_large_vocabulary():
    rng = random.Random(2)
    ws = [f"{rng.randrange(60_000)}".encode() for _ in range(150_000)]
    ws += ws[100:120]
    assert quality.repeated_words(ws) == brute_repeats(ws)


# ---------------------------------------------------------------- LM scoring

def brute_scores(texts, corpus, order, alpha, leave_one_out):
    lower = lambda t: [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")]
    grams = lambda ws: Counter(tuple(ws[i:i + n]) for n in range(1, order + 1) for i in range(len(ws) - n + 1))
    total = Counter()
    for t in corpus:
        total.update(grams(lower(t)))
    words = sum(len(lower(t)) for t in corpus)
    out = []
    for t in texts:
        ws, sum_ = lower(t), 0.0
        own = grams(ws) if leave_one_out else Counter()
        known = max(words - (len(ws) if leave_one_out else 0), 1)
        for i in range(len(ws)):
            factor = 1.0
            for n in range(min(order, i + 1), 0, -1):
                gram = tuple(ws[i - n + 1:i + 1])
                c = total[gram] - own[gram]
                if c > 0:
                    sum_ += math.log(factor * c / (total[gram[:-1]] - own[gram[:-1]] if n > 1 else known))
                    break
                factor *= alpha
            else:
                sum_ += math.log(factor / known)
        out.append((len(ws), round(sum_, 6)))
    return out


@pytest.mark.parametrize("order", [1, 2, 3])
def test_lm_scores_against_brute_force(spark, monkeypatch, order):
    from tessera.llm import lm_scoring

    monkeypatch.setattr(lm_scoring, "RANGE_GRAMS", 700)
    rng = random.Random(16)
    texts = [None, "", " \n", "One", "one", "ONE two É", words(rng, 4000, 90)] + [words(rng, rng.randint(1, 80), 40).upper() for _ in range(60)]
    texts += [texts[8]] * 3
    ids = [None, None, *range(2, len(texts))]
    docs = frame(spark, texts, ids=ids).repartition(5)
    rows = lambda df: Counter((r.id, r.n_words, round(r.log_score, 6)) for r in df.collect())
    for leave in (True, False):
        want = Counter((i, *x) for i, x in zip(ids, brute_scores(texts, texts, order, 0.4, leave)))
        assert rows(lm_scoring.score_documents(docs, order=order, leave_one_out=leave)) == want
    other = [words(rng, 50, 60) for _ in range(20)] + [None]
    want = Counter((i, *x) for i, x in zip(ids, brute_scores(texts, other, order, 0.4, False)))
    assert rows(lm_scoring.score_documents(docs, frame(spark, other), order=order)) == want
    nothing = lm_scoring.score_documents(docs, docs.limit(0), order=order)
    assert rows(nothing) == Counter((i, *x) for i, x in zip(ids, brute_scores(texts, [], order, 0.4, False)))
    assert {r.mean_log_score for r in nothing.collect() if not r.n_words} == {None}
    assert lm_scoring.score_documents(docs.limit(0), order=order).count() == 0


@pytest.mark.parametrize("alone", [True, False])
def test_exploded_ngrams_are_shuffled_once(spark, alone):
    from tessera.llm import lm_scoring

    blocks = lm_scoring.to_blocks(frame(spark, ["a b c", "a b d"] * 20))
    totals = lm_scoring.count_pass(blocks, None, 2, 0, 1, 3, alone)
    totals.collect()
    plan = totals._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1


def test_counts_join_blocks_that_stay_where_they_are(spark):
    """Blocks are the largest table; only counts are shuffled to them."""
    from tessera.llm import lm_scoring
    from tessera.llm.common import stash

    blocks = lm_scoring.to_blocks(frame(spark, ["a b c", "a b d"] * 20).repartition(4), buckets=3)
    totals = stash(lm_scoring.count_pass(blocks, None, 2, 0, 1, 3, True), "lm-totals")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        answered = lm_scoring._with_answers(blocks, totals, 3)
        assert answered.count() == blocks.count() == 4
        plan = answered._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


def test_small_rows_are_not_weighed(spark):
    """Spark weighs each row for Python where a batch is limited by bytes; texts need that, counts do not."""
    from tessera.llm.common import ARROW_BYTES, prepare_workers, rows_of_numbers

    prepare_workers(spark)
    limit = spark.conf.get(ARROW_BYTES)
    with rows_of_numbers(spark):
        assert spark.conf.get(ARROW_BYTES) == str((1 << 31) - 1)
    assert spark.conf.get(ARROW_BYTES) == limit != str((1 << 31) - 1)


def test_words_of_blocks_against_split():
    import pyarrow as pa

    from tessera.llm.lm_scoring import _words

    rng = random.Random(1)
    texts = [None, b"", b" ", b"A\0b \x1f\x85 x\x0b\x0cy\t\n\r", "ÉA\u00a0é".encode(), b"a", b"b", b"a\0", b"a\0\0"]
    texts += [bytes(rng.choice(b" \t\nabAB\0\xff") for _ in range(rng.randint(0, 300))) for _ in range(200)]
    texts += [b"Q" * n for n in (7, 8, 9, 16, 17, 63, 64, 65, 72, 73, 200)] + [b"q" * 65 + b" " + b"q" * 200]
    for some in (pa.array(texts, pa.binary()), pa.array(texts * 2, pa.binary()).slice(13, 190), pa.array(texts[:1], pa.binary()), pa.array([], pa.binary())):
        want = [(t or b"").lower().split() for t in some.to_pylist()]
        lengths, hashes, numbers = _words(some.fill_null(b""))
        first: dict[bytes, int] = {}
        assert numbers.tolist() == [first.setdefault(w, len(first)) for own in want for w in own]
        assert lengths.tolist() == [len(own) for own in want] and len({*hashes.tolist()}) == len(hashes) == len(first)


def test_registered_lm_scores_use_trigrams(spark, tmp_path):
    from tessera.llm import queries

    rng = random.Random(17)
    texts = [None, "a", "a b", *(words(rng, rng.randint(3, 60), 12) for _ in range(40))]
    frame(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 6)) for r in queries.op7_lm_scoring(spark, str(tmp_path)).collect())
    wanted = {order: Counter((i, *x) for i, x in enumerate(brute_scores(texts, texts, order, 0.4, True))) for order in (2, 3)}
    assert wanted[2] != wanted[3] and got == wanted[3]


# ---------------------------------------------------------------- suffix arrays

def brute_removal(texts, m):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + m] for d in data for i in range(len(d) - m + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - m + 1):
            if seen[d[i:i + m]] > 1:
                gone[i:i + m] = b"\1" * m
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        kept = bytes(c for c, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, sha256(kept).hexdigest()))
    return out


def suffix_texts(rng):
    passage = words(rng, 120)
    texts = [None, "", "é" * 700, "ab" * 400, words(rng, 20), passage, words(rng, 900)]
    for _ in range(50):
        kind = rng.random()
        if kind < 0.4:
            a = rng.randrange(300)
            texts.append(words(rng, rng.randint(0, 60)) + " ü " + passage[a:a + rng.randint(150, 500)] + words(rng, rng.randint(0, 60)))
        elif kind < 0.7:
            near = list(rng.choice(texts[6:]) or "x")
            for _ in range(rng.randint(0, 4)):
                if near:
                    near[rng.randrange(len(near))] = "Ö"
            texts.append("".join(near))
        else:
            texts.append(words(rng, rng.randint(10, 200)))
    return texts + [texts[6]] * 5


@pytest.mark.parametrize("split", [False, True])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, split):
    texts = suffix_texts(random.Random(12))
    if split:  # many shards, and several for one gram
        monkeypatch.setattr(suffix_dedup, "GRAM_CONTEXTS", 2)
        monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 5000)
    ids = [*range(len(texts) - 5), 6, 6, None, None, 3]
    want = Counter((i, *r) for i, r in zip(ids, brute_removal(texts, 200)))
    docs = frame(spark, texts, ids=ids)
    out = suffix_dedup.remove_repeats(docs)
    got = out.select("id", "n_bytes", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    assert Counter(map(tuple, got)) == want
    if not split:
        assert suffix_dedup.remove_repeats(docs.limit(0)).count() == 0


def test_suffix_array_and_kasai():
    import numpy as np

    rng = random.Random(13)
    data = bytes(rng.choice(b"ab") for _ in range(900)) + b"abab" * 50
    w = suffix_dedup._words(np.frombuffer(data, np.uint8))
    order, rank = suffix_dedup.suffix_array(w)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
    common = suffix_dedup.kasai(w, order, rank, 60, lane=37)  # lanes of any length
    for r in range(1, len(order)):
        a, b = data[order[r - 1]:], data[order[r]:]
        n = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[order[r]] == min(n, 60)


def test_windows_of_many_short_contexts():
    rng = random.Random(15)
    for alphabet in ("a", "ab", "abcdefgh"):
        base = "".join(rng.choice(alphabet) for _ in range(300))
        contexts = []
        for _ in range(40):
            a = rng.randrange(250)
            contexts.append((base[a:a + rng.randint(0, 80)] + "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20)))).encode())
        m = 17
        number, offset, found, classes = suffix_dedup.repeated_starts(contexts, m)
        windows = [contexts[k][o:o + m] for k, o in zip(number.tolist(), offset.tolist())]
        times = Counter(windows)
        assert sorted(windows) == sorted(c[o:o + m] for c in contexts for o in range(len(c) - m + 1))
        assert [times[w] > 1 for w in windows] == found.tolist()
        by_class = dict(zip(classes.tolist(), windows))
        assert len(by_class) == len(times) and [by_class[c] for c in classes.tolist()] == windows


def test_long_documents_go_in_pieces(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 500)
    import numpy as np

    text = words(random.Random(14), 400).encode()
    covered = []
    for data, ends, number, offset in suffix_dedup._units([text, b"", text[:300]], 200):
        first, last, anchor, gram = suffix_dedup.anchors(data, ends)
        part = np.searchsorted(ends, first, "right")
        starts = np.concatenate(([0], ends[:-1]))
        for f, l, p in zip(first.tolist(), last.tolist(), part.tolist()):
            covered += [(int(number[p]), f - int(starts[p]) + int(offset[p]) + k) for k in range(l - f + 1)]
    assert sorted(covered) == [(0, i) for i in range(len(text) - 199)] + [(2, i) for i in range(101)]


def test_own_occurrences_by_document():
    from tessera.llm.lm_scoring import _own

    rng = np.random.default_rng(3)
    doc, hashes = np.sort(rng.integers(0, 9, 700)), rng.integers(0, 12, 700).astype(np.uint64)
    want = Counter(zip(doc.tolist(), hashes.tolist()))
    assert _own(doc, hashes).tolist() == [want[x] for x in zip(doc.tolist(), hashes.tolist())]
    assert _own(doc[:0], hashes[:0]).tolist() == []


@pytest.mark.parametrize("spread", [3, 1 << 20, 1 << 64])
def test_places_among_distinct_hashes(spread):
    from tessera.llm.lm_scoring import _groups

    rng = random.Random(spread)
    few = [rng.randrange(spread) for _ in range(50)]
    for size in (0, 1, 2, 700):
        hashes = np.array([rng.choice(few) for _ in range(size)], np.uint64)
        place, distinct = _groups(hashes)
        assert distinct.tolist() == sorted({*hashes.tolist()}) and distinct[place].tolist() == hashes.tolist()


def test_counts_return_to_blocks_in_one_row_for_each(monkeypatch):
    import pyarrow as pa

    from tessera.llm import lm_scoring

    rng = random.Random(5)
    rows = [(rng.choice([3, 1 << 33, 9]), place, rng.choice([1, 7, 1 << 35] if place % 3 else [2])) for place in rng.sample(range(1 << 20), 400)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows])], names=["block", "place", "total"])
    for limit, n_rows in ((1 << 20, 3), (100, 12)):
        monkeypatch.setattr(lm_scoring, "_TOTALS_ROWS", limit)
        packed = pa.Table.from_batches([*lm_scoring._totals(iter([batch.slice(i, 50) for i in range(0, 400, 50)]), 2, 1)])
        assert packed.num_rows == n_rows
        got = []
        for row in packed.to_pylist():
            listed = pa.array([[{c: row[c] for c in ("n", "pass", "places", "totals")}]])
            (key, [(places, totals)]), = lm_scoring._answers(pa.RecordBatch.from_arrays([listed], names=["answers"]), 0).items()
            assert key == (2, 1)
            got += [(row["block"], *x) for x in zip(places.tolist(), totals.tolist())]
        assert sorted(got) == sorted(rows)


@pytest.mark.parametrize("min_bytes", [47, 1072])
def test_suffix_dedup_refuses_lengths_its_places_cannot_hold(spark, min_bytes):
    from tessera.llm.suffix_dedup import remove_repeats

    with pytest.raises(ValueError):
        remove_repeats(frame(spark, ["a"]), min_bytes=min_bytes)


def test_dropping_anything_but_a_stash_is_refused(spark, tmp_path):
    from tessera.llm.common import drop_stash, stash

    spark.range(3).write.parquet(f"{tmp_path}/kept")
    with pytest.raises(ValueError):
        drop_stash(spark.read.parquet(f"{tmp_path}/kept"))
    assert spark.read.parquet(f"{tmp_path}/kept").count() == 3
    stashed = stash(spark.range(5), "dropped")
    folder = stashed.inputFiles()[0].rsplit("/", 1)[0]
    drop_stash(stashed)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
