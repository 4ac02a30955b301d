"""The registered queries op1 to op10 on one hand-made folder: nulls, empty texts, repeated rows, ties and clashing columns. Each must give its
contract's columns; SQL, where there is some, is run by DuckDB on the same files."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, sql

from .test_native_operators import brute_lines, brute_targets, brute_url, brute_warc, payloads
from .test_text_operators import SYLLABLES, WORD, brute_components, brute_contaminated, brute_fingerprint, brute_removal, speak, words


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(21)
    path = str(tmp_path_factory.mktemp("handmade"))
    items = [(1, words(rng, 30, 900)), (2, "one two three four five six"), (3, "yes"), (4, None)]
    docs = [(0, None, "en", "a"), (1, "", None, None), (2, " \n\t", "fr", "b"), (3, "́ ̀", "en", "a"), (4, "12 !!", None, "c")]
    for k in range(5, 95):
        lang = rng.choice(list(SYLLABLES))
        lines = [speak(rng, lang, rng.randint(2, 30)) for _ in range(rng.randint(1, 5))]
        if k % 4 == 0:
            lines.append("A line that many documents hold")
        if k % 11 == 0:
            lines.append(rng.choice(items[:2])[1].upper())
        docs.append((k, "\n".join(lines), lang if k % 9 else None, rng.choice(["a", "a", "b", None])))
    docs += [docs[10], docs[10], (200, docs[10][1], "en", "a"), (201, docs[12][1] + " x", "fr", "b"), (202, docs[14][1].upper(), None, "c"), (12, "other text", "en", "a")]
    d = spark.createDataFrame([(i, t, lang, s, len(t or ""), -1, "x") for i, t, lang, s in docs], "doc_id long, text string, lang string, source string, n_chars long, id long, host string")
    d.repartition(4).write.parquet(f"{path}/documents.parquet")
    html = payloads(rng)
    urls = [None, "", "http://EXAMPLE.org/es/1", "https://b.de/x", "http://free-bets.net/", "http://a.com/fr/?q=/de/", "ftp://x/tracker/1#y"]
    pages = [(k, urls[k % len(urls)], h) for k, h in enumerate(html)] + [(3, "http://a.org/", html[3]), (3, "http://a.org/", html[3])]
    spark.createDataFrame([(*p, 0) for p in pages], "page_id long, url string, html string, rule int").repartition(3).write.parquet(f"{path}/pages.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, pages, items


def run(spark, folder, name):
    df = queries.QUERIES[name](spark, folder[0])
    return df, df.collect()


def test_op1_contract(spark, folder):
    df, rows = run(spark, folder, "op1_language_id")
    assert df.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    docs = folder[1]
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.lang_pred in {*SYLLABLES, "und"} and (r.lang_pred == "und") == (r.doc_id < 5)
    truth = {i: lang for i, _, lang, _ in docs[5:95] if lang}
    held = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out and 5 <= r.doc_id < 95 and r.doc_id in truth and r.doc_id != 12]
    assert len(held) > 15 and sum(held) > 0.9 * len(held)


def test_op2_contract(spark, folder):
    df, rows = run(spark, folder, "op2_mixing")
    assert df.dtypes[:5] == [("doc_id", "bigint"), ("size", "bigint"), ("source_size", "bigint"), ("target", "double"), ("taken", "bigint")]
    count, sizes = (lambda t: len(WORD.findall(t or ""))), Counter()
    for _, t, _, s in folder[1]:
        sizes[s] += count(t)
    target = brute_targets(sizes, (3, 1, 2), 1.5, 2)
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, count(t)) for i, t, *_ in folder[1])
    taken = defaultdict(int)
    for r in rows:
        assert r.taken <= 2 * r["size"]
        taken[r.source_size, round(r.target, 6)] += r.taken
    assert set(taken) == {(sizes[s], round(target[s], 6)) for s in sizes}
    assert all(abs(n - t) <= 1 for (_, t), n in taken.items())
    assert Counter(map(tuple, run(spark, folder, "op2_mixing")[1])) == Counter(map(tuple, rows))


def test_op3_contract(spark, folder):
    _, rows = run(spark, folder, "op3_warc")
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows)
    assert got == Counter(brute_warc([p[0] for p in folder[2]], [p[2] for p in folder[2]]))


def test_op4_contract(spark, folder):
    _, rows = run(spark, folder, "op4_simhash")
    fp = {t: brute_fingerprint(t) for _, t, *_ in folder[1]}
    component = brute_components(sorted(set(fp.values())), 2)
    least = {}
    for i, t, *_ in folder[1]:
        c = component[fp[t]]
        least[c] = min(i, least.get(c, i))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in rows) == Counter((i, f"{fp[t]:016x}", least[component[fp[t]]]) for i, t, *_ in folder[1])


def test_op5_contract(spark, folder):
    _, rows = run(spark, folder, "op5_suffix_dedup")
    want = Counter((i, *r) for (i, *_), r in zip(folder[1], brute_removal([t for _, t, *_ in folder[1]], 200)))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows) == want


def test_op6_contract(spark, folder):
    _, rows = run(spark, folder, "op6_url_filter")
    blocked = queries.url_block_words()
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in rows) == Counter((i, *brute_url(u, blocked)) for i, u, _ in folder[2])


def test_op8_contract(spark, folder):
    _, rows = run(spark, folder, "op8_line_dedup")
    want = brute_lines([i for i, *_ in folder[1]], [t for _, t, *_ in folder[1]])
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in rows) == Counter((i, n, d, sha256(t.encode()).hexdigest()) for i, n, d, t in want)


def test_op9_contract(spark, folder):
    _, rows = run(spark, folder, "op9_decontamination")
    want = Counter((i, tuple(brute_contaminated(t, folder[3]))) for i, t, *_ in folder[1])
    assert Counter((r.doc_id, tuple(r["items"])) for r in rows) == want and any(f for _, f in want)


def test_op10_contract(spark, folder):
    df, rows = run(spark, folder, "op10_quality")
    assert df.columns[:8] == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    by_id = defaultdict(set)
    for i, t, *_ in folder[1]:
        ws = WORD.findall(t or "")
        by_id[i].add((len(ws), sum(map(len, ws))))
    assert all((r.n_words, r.word_chars) in by_id[r.doc_id] and (not r.base_failed or not r.kept) for r in rows) and len(rows) == len(folder[1])


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_sql_agrees(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder[0]}/{table}.parquet/*.parquet')")
    result = con.execute(sql.ORACLES[name])
    columns = [c[0] for c in result.description]
    got = queries.QUERIES[name](spark, folder[0])
    assert sorted(got.columns) == sorted(columns)
    text = lambda row: tuple(map(str, row))
    assert Counter(map(text, got.select(*[F.col(c) for c in columns]).collect())) == Counter(map(text, result.fetchall()))
