"""Spelling variants, token files and periodic runs against brute force, through their registered queries and directly."""

import os
import random
import re
import zlib
from collections import Counter
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import periodic_runs, queries, spelling, token_files

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile("[A-Za-zÀ-ÿ]+")
AZ = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, word string, n long, text_hash string"


def write_documents(spark, tmp_path, rows):
    """A folder with documents and clashing extra columns; ``rows``: (doc_id, text)."""
    path = str(tmp_path)
    spark.createDataFrame([(i, t, "en", "s", 0, -1, "x", -2, "h") for i, t in rows], SCHEMA).repartition(5).write.parquet(f"{path}/documents.parquet")
    return path


# ---------------------------------------------------------------- spelling variants

def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute_variants(counts, ratio=2):
    out = {}
    for w, n in counts.items():
        near = [v for v in counts if one_edit(w, v)]
        best = min(near, key=lambda v: (-counts[v], v), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[w] = (n, len(near), form, counts[form] if form else None)
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w] += (root,)
    return out


def got_variants(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def contract_words(rows):
    count = Counter()
    for i, text in rows:
        for run in LETTERS.findall(text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def misspell(rng, word):
    k = rng.randrange(len(word))
    return rng.choice((word[:k] + word[k + 1:], word[:k] + rng.choice("aé×z") + word[k:], word[:k] + rng.choice("aÀq") + word[k + 1:]))


def test_registered_spelling_query(spark, tmp_path):
    rng = random.Random(1)
    roots = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(4, 9))) for _ in range(60)]
    texts = [None, "", "1234 --", "Straße STRASSE Àéî×ÿ " * 3]
    for _ in range(160):
        own = [rng.choice(roots) for _ in range(30)]
        texts.append(" ".join(misspell(rng, w).upper() if rng.random() < 0.3 else w for w in own))
    texts += [texts[5]] * 3 + ["x" * 5000 + " " + "x" * 4999 + " "] * 4 + [("x" * 4998 + "y ") * 9]
    texts.append("planta " * 4 + "plantas " * 10 + "plantass " * 30)
    rows = list(enumerate(texts)) + [(7, texts[9]), (None, texts[8])]
    want = brute_variants(contract_words([("" if i is None else i, t) for i, t in rows]))
    got = got_variants(queries.op11_spelling_variants(spark, write_documents(spark, tmp_path, rows)))
    assert got == want
    assert len(want) > 100 and any(v[2] and v[2] != v[4] for v in want.values())  # chains of forms


@pytest.mark.parametrize("group_rows, task_rows", [(4096, 20_000), (8, 30), (2, 5)])
def test_variants_by_any_cut(spark, group_rows, task_rows):
    rng = random.Random(group_rows)
    counts = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 9))): rng.choice((1, 2, 4, 8, 16)) for _ in range(400)}
    df = spark.createDataFrame([(w, n, "z") for w, n in counts.items()], "word string, n long, form string")
    assert got_variants(spelling.variant_groups(df, 2, group_rows, task_rows)) == brute_variants(counts)


def test_chain_of_forms_is_followed_to_its_end(spark):
    counts = {"aaaaaa" + "b" * k: 3 << k for k in range(12)}
    got = got_variants(spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts)
    assert {v[4] for v in got.values()} == {"aaaaaa" + "b" * 11}


def test_no_words(spark):
    assert spelling.variant_groups(spark.createDataFrame([], "word string, n long")).collect() == []
    with pytest.raises(ValueError):
        spelling.variant_groups(spark.createDataFrame([], "word string, n long"), ratio=1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abc", max_size=6), min_size=1, max_size=6), st.lists(st.text("abc", max_size=6), min_size=1, max_size=6))
def test_shared_ends_tell_single_edits(a, b):
    ahead, back = spelling.shared_ends(a, b)
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            near = x != y and abs(len(x) - len(y)) < 2 and ahead[i, j] + back[i, j] >= max(len(x), len(y)) - 1
            assert near == one_edit(x, y)


def test_tiles_shrink_for_long_words():
    tiles = spelling._tiles(np.array([6] * 300 + [2000] * 40 + [3_000_000] * 2))
    assert [a for a, _ in tiles] == [0, *(b for _, b in tiles[:-1])] and tiles[-1][1] == 342
    assert max(b - a for a, b in tiles) == 128 and tiles[-1] == (341, 342)


# ---------------------------------------------------------------- token files

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def whole_ids(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("aB'sé 1ß\n\t\x1c\x85 　Σς́漢<|>.,nd#%)") | st.characters(exclude_categories=["Cs"]), max_size=40))
def test_word_by_word_equals_whole_texts(tokenizer, text):
    assert token_files.encode_text(text, token_files.WordIds(tokenizer)).tolist() == whole_ids(tokenizer, text)


def test_special_strings_and_words_by_parts(tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "_MAX_WORDS", 5)
    words = token_files.WordIds(tokenizer)
    for text in ("a<|endoftext|>b <|startoftext|>", "x" * 300, "don't stop\nit's  so  fine: Yes, YES! é, 5. .. , Wörd###&&& x) a'.%% word'S, 7%" * 40):
        assert token_files.encode_text(text, words).tolist() == whole_ids(tokenizer, text)
    assert token_files.encode_text("a b  c", words, by_word=False).tolist() == whole_ids(tokenizer, "a b  c")


def test_words_of_letters_go_to_the_model(tokenizer):
    class Refusing:
        def __getattr__(self, name):
            assert name != "encode"
            return getattr(tokenizer, name)

    rng = random.Random(23)
    text = " ".join("".join(rng.choice("aeiounrstAEéèçßÑøſ") for _ in range(rng.randint(1, 12))) for _ in range(1000))
    assert token_files.encode_text(text, token_files.WordIds(Refusing())).tolist() == whole_ids(tokenizer, text)


def test_letters_of_other_tokenizers(tokenizer):
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    assert {*map(ord, "azAZéßø")} <= token_files.plain_letters(tokenizer).keys() and ord("İ") not in token_files.plain_letters(tokenizer)
    for change in ("normalizer", "pre_tokenizer", "added"):
        other = Tokenizer.from_str(tokenizer.to_str())
        if change == "normalizer":
            other.normalizer = normalizers.Replace("ab", "c")
        elif change == "pre_tokenizer":
            other.pre_tokenizer = pre_tokenizers.Split("z", "isolated")
        else:
            other.add_special_tokens(["PAD"])
        assert token_files.plain_letters(other) == {}


@pytest.mark.parametrize("word", ["İ,", "aİ.", "\u0958,", "x\u0958!?"])
def test_letters_that_become_a_letter_and_a_mark(tokenizer, word):
    assert token_files.encode_text(word, token_files.WordIds(tokenizer)).tolist() == whole_ids(tokenizer, word)


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(categories=["L"], max_codepoint=0x24F), min_size=1, max_size=8))
def test_words_of_any_latin_letters(tokenizer, word):
    assert token_files.encode_text(word, token_files.WordIds(tokenizer)).tolist() == whole_ids(tokenizer, word)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 32), st.integers(0, 40), st.integers(0, 2**32 - 1))
def test_blocks_round_trip(n, bits, outliers, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, 1 << bits, n, dtype=np.uint64).astype(np.uint32) if bits else np.full(n, seed, np.uint32)
    if n:
        ids[rng.integers(0, n, outliers)] = rng.integers(0, 1 << 32, outliers, dtype=np.uint64)
    segment = token_files.Segment(b"junk" + token_files.write_segment(1, 2, ids, np.zeros(0, token_files._DOC)), 4)
    assert segment.ids_between(0, n).tolist() == ids.tolist()
    a, b = sorted(rng.integers(0, n + 1, 2).tolist())
    assert segment.ids_between(a, b).tolist() == ids[a:b].tolist()


def test_blocks_keep_outliers_apart():
    ids = np.arange(1024, dtype=np.uint32) % 16 + 1000
    ids[[3, 700]] = 4_000_000_000
    index, payload = token_files.pack_blocks(ids)
    assert (index["least"][0], index["width"][0], index["exceptions"][0]) == (1000, 4, 2)
    assert len(payload) == 1024 * 4 // 8 + 2 * 6
    with pytest.raises(ValueError):
        token_files.Segment(b"x" * 64)


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_joined_crc(a, b):
    assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def brute_tokens(tokenizer, rows):
    """(doc_id, start, n, crc), sorted; rows of equal id may stand in any order if their texts differ."""
    encoded = {}
    for i, t in rows:
        encoded.setdefault(i, []).append([*whole_ids(tokenizer, t), 2])
    return encoded


def check_tokens(got, encoded):
    start, by_id = 0, {}
    for r in sorted(got, key=lambda r: r[1]):
        assert r[1] == start
        start += r[2]
        by_id.setdefault(r[0], []).append((r[2], r[3]))
    assert list(by_id) == sorted(encoded, key=lambda i: (i is None, i))
    for i, own in encoded.items():
        assert sorted(by_id[i]) == sorted((len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for x in own)


def token_rows():
    rng = random.Random(2)
    texts = [None, "", " \n", "Hello, World!", "<|endoftext|>", "word " * 5000, "é" * 900]
    texts += [" ".join(f"w{rng.randrange(90)}-Ünï{rng.randrange(9)}" for _ in range(rng.randrange(60))) for _ in range(150)]
    ids = rng.sample(range(-1000, 1000), len(texts))
    return list(zip(ids, texts)) + [(ids[3], texts[3]), (ids[3], "another text"), (None, "no id"), (1 << 40, "far")]


def test_registered_token_query(spark, tmp_path, tokenizer):
    rows = token_rows()
    got = queries.op12_token_files(spark, write_documents(spark, tmp_path, rows))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check_tokens([tuple(r) for r in got.collect()], brute_tokens(tokenizer, rows))


@pytest.mark.parametrize("by_word", [True, False])
def test_documents_over_many_segments_and_files(spark, tmp_path, tokenizer, by_word):
    rows = token_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    path = str(tmp_path / "files")
    token_files.write_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), 2, by_word, piece_chars=40, task_bytes=9000, segment_ids=300)
    assert len([f for f in os.listdir(path) if f.startswith("part-")]) > 8
    check_tokens([tuple(r) for r in token_files.read_files(spark, path).collect()], brute_tokens(tokenizer, rows))


def test_long_texts_are_cut_behind_spaces(spark):
    texts = ["alpha beta\ngamma " * 9, "x" * 50 + " y", "  " * 30, "a" * 20 + "\n" + "b" * 21, "漢 字" * 14, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = token_files.text_pieces(docs, 20, "doc_id", "text").orderBy("row", "piece").collect()
    for i, text in enumerate(texts):
        own = [r for r in got if r["id"] == i]
        assert "".join(r["text"] for r in own) == (text or "")
        assert [r["last"] for r in own] == [False] * (len(own) - 1) + [True]
        assert all(r["text"][-1] in " \n" for r in own[:-1]) and all(len(r["text"]) <= 21 or " " not in r["text"][:-1] for r in own)


def test_no_documents_no_tokens(spark, tmp_path):
    assert queries.op12_token_files(spark, write_documents(spark, tmp_path, [])).collect() == []


# ---------------------------------------------------------------- periodic runs

def brute_runs(words, min_length=24, min_periods=3):
    """Every maximal stretch with smallest period q, by the definition."""
    n, out = len(words), []
    for q in range(1, n // min_periods + 1):
        k = q
        while k < n:
            if words[k] != words[k - q]:
                k += 1
                continue
            first = k
            while k < n and words[k] == words[k - q]:
                k += 1
            s, length = first - q, k - first + q
            part = words[s:k]
            smaller = any(all(part[x] == part[x - p] for x in range(p, length)) for p in range(1, q))
            if length >= max(min_length, min_periods * q) and not smaller:
                out.append((s, length, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def contract_runs(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha256(lines.encode()).hexdigest(), sha256(kept.encode()).hexdigest())


def repeating_text(rng):
    words = []
    for _ in range(rng.randint(0, 5)):
        root = [rng.choice("abcde") + rng.choice("xyé") for _ in range(rng.choice((1, 2, 3, 7, 8, 9, 15, 17, 33, 40)))]
        length = rng.randint(1, 5 * len(root) + 10)
        words += [root[k % len(root)] for k in range(length)] + [rng.choice("abcde") + "x" for _ in range(rng.randrange(4))]
    return "".join(w + rng.choice((" ", "\n", "\t ", "  ")) for w in words)


def test_registered_run_query(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i, repeating_text(rng)) for i in range(150)] + [(200, None), (201, ""), (202, " \n"), (None, "a " * 60), (3, "a b " * 40), (3, "a b " * 40)]
    tenth = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 10 == 0][:40]
    rows += [(i, rng.choice((" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(1, 200))), repeating_text(rng)))) for i in tenth[3:]]
    rows += list(zip(tenth, (None, "", "\t")))
    got = queries.op13_periodic_runs(spark, write_documents(spark, tmp_path, rows)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    want = [(i, *contract_runs(i, t)) for i, t in rows]
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert sum(w[1] > 0 for w in want) > 60 and any(w[1] > 1 for w in want)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.tuples(st.text("ab", min_size=1, max_size=3), st.integers(1, 30)), max_size=4), min_size=1, max_size=3),
       st.sampled_from([(24, 3), (2, 3), (5, 4), (30, 3)]))
def test_runs_equal_the_definition(parts, limits):
    texts = [" ".join(" ".join(c for c in (root * k)) for root, k in part) for part in parts]
    row, starts = periodic_runs.number_words([t.encode() for t in texts])
    got = periodic_runs.runs_of(row, starts, *limits)
    want = [(s + starts[k], length, q) for k, t in enumerate(texts) for s, length, q in brute_runs(t.split(), *limits)]
    assert [tuple(r) for r in got.tolist()] == want


def test_long_periodic_texts_stay_cheap():
    for text, run in ((b"a " * 300_000, (0, 300_000, 1)), (b"a b c d e f g " * 60_000, (0, 420_000, 7)),
                      (b" ".join(b"w%d" % k for k in range(50_000)) + b" ", (0, 150_000, 50_000))):
        row, starts = periodic_runs.number_words([text * 3 if run[2] == 50_000 else text])
        assert periodic_runs.runs_of(row, starts).tolist() == [[1, *run[1:]]]


def test_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PIECE_BYTES", 7)
    text = b"  aa b\n\nccccccccccccc d e f " * 9 + b"end"
    assert [w for p in periodic_runs.pieces_of(text) for w in p] == text.split()
    runs = np.array([[0, 54, 6]])
    words = text.split()
    assert periodic_runs.collapse(text, runs) == b" ".join(words[:6] + words[54:])
    assert periodic_runs.collapse(text, runs[:0]) == b" ".join(words)


def test_unsupported_limits():
    for limits in ((24, 2), (1, 3)):
        with pytest.raises(ValueError):
            periodic_runs.runs_of(np.array([5]), np.array([0]), *limits)


def test_no_documents_no_runs(spark, tmp_path):
    assert queries.op13_periodic_runs(spark, write_documents(spark, tmp_path, [])).collect() == []
