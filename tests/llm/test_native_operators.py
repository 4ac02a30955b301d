"""Line dedup, URL filters, mixing, WARC and the pipeline against brute force."""

import random
import re
from base64 import b32encode
from collections import Counter, defaultdict
from hashlib import sha1

import pytest
from pyspark.sql import functions as F

from tessera.llm import line_dedup, mixing, url_filter, warc

from .test_text_operators import WORD, brute_components, brute_contaminated, brute_fingerprint, frame, words

AZ = {c: c + 32 for c in range(65, 91)}


# ---------------------------------------------------------------- line dedup

def brute_lines(ids, texts):
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    for i, t in zip(ids, texts):
        for line in (t or "").split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").translate(AZ)
            if len(key) >= 10:
                holders[key].add(i)
    out = []
    for i, t in zip(ids, texts):
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            who = holders.get(line.strip(" \t\n\x0b\x0c\r").translate(AZ), set())
            if len(who) < 2 or min(who, key=order) == i:
                kept.append(line)
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_texts(rng):
    pool = [words(rng, rng.randint(1, 6), 9) for _ in range(30)] + ["", "  ", "short", "ÀBCDEFGHIJ é", "tenletters", "ninechars"]
    dress = lambda x: rng.choice([x, x.upper(), f" {x}\t", x + "\r", "\x0b" + x])
    texts = [None, "", "\n", "\n\n"] + ["\n".join(dress(rng.choice(pool)) for _ in range(rng.randint(1, 30))) for _ in range(80)]
    return texts + ["\n".join(f"line number {k} of a long text" for k in range(3000))] * 2


def test_line_dedup_against_brute_force(spark):
    texts = line_texts(random.Random(1))
    ids = [*range(len(texts) - 3, 0, -1), None, None, 5]
    docs = frame(spark, texts, ids=ids)
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = kept.select("id", "n_lines", "n_dropped", "kept_text").collect()
    assert Counter(map(tuple, got)) == Counter(brute_lines(ids, texts))
    assert kept.select("row.H").distinct().collect()[0][0] == "y"
    assert line_dedup.dedup_lines(docs).columns == docs.columns
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_bitmaps_are_runs(spark):
    docs = frame(spark, ["a line of text\nown one", "x\na line of text\ny\nA LINE OF TEXT\nz"])
    row = line_dedup.keep_bitmaps(docs).first()
    assert row.id == 1 and [tuple(r) for r in row.keep_runs] == [(0, 1), (2, 1), (4, 1)]


# ---------------------------------------------------------------- URL filters

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))


def brute_url(url, block_words):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group().translate(AZ)
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    fits = [(len(r), r, v) for r, v in RULES for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    rule, verdict = max(fits)[1:] if fits else (None, None)
    blocked = any(re.search(rf"(^|[^a-z0-9]){w}([^a-z0-9]|$)", (host + path).lower()) for w in block_words)
    return host, path, rule, verdict or ("block" if blocked else "allow")


def test_url_filter_against_brute_force(spark):
    rng = random.Random(2)
    hosts = ["example.org", "EXAMPLE.org", "a.example.org", "notexample.org", "org", "x.com", "com", "adult.x.net", "casino-win.net", "casinos.net", "b.de", ""]
    paths = ["", "/", "/es", "/es/", "/es/4", "/en/1", "/en/12", "/en/2", "/fr/", "/de/7", "/a/Casino/b", "/fr?x=/de/", "#/es/", "/é/casino"]
    urls = [None, "", "example.org/es/", "://", "http:///es/"] + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(500)]
    ids = [None, None, 1, 1, *range(2, len(urls) - 2)]
    pages = spark.createDataFrame([(i, u, "h", "p", 1) for i, u in zip(ids, urls)], "page_id long, url string, host string, path string, rule int")
    rules = [url_filter.host_rule(*r) for r in RULES] + [url_filter.word_rule(w) for w in ("adult", "casino")]
    got = url_filter.judge_urls(pages, rules)
    assert Counter((r.id, r.host, r.path, r.rule, r.verdict) for r in got.collect()) == Counter((i, *brute_url(u, ("adult", "casino"))) for i, u in zip(ids, urls))
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_rules_are_indexed_by_their_rarest_token(spark):
    assert url_filter.host_rule("example.org/en/1", "block").tokens == ("example", "org", "en")
    rules = [url_filter.host_rule("example.org/en/", "block"), url_filter.UrlRule("any", "x{3}", "block", (), 1, 1)]
    targets = spark.createDataFrame([(["", "example", "org"],), (["", "org", "en"],), (["", "org", "en"],)], "tokens array<string>")
    index = {r.rule: r.token for r in url_filter.rarest_token_index(targets, url_filter.rule_table(spark, rules)).collect()}
    assert index == {"example.org/en/": "example", "any": ""}


# ---------------------------------------------------------------- mixing

def brute_targets(sizes, weights, share, repeat):
    weight = {s: weights[k % len(weights)] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    target, open_, left = {}, set(sizes), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > repeat * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = repeat * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def mix_docs(spark):
    rng = random.Random(3)
    texts = [None, "", None, "one"] + [words(rng, rng.choice([0, 3, 40, 300, 2000])) for _ in range(200)]
    sources = [None, "empty", None, "tiny"] + [rng.choice(["a", "a", "a", "b", "é", "Z", None]) for _ in range(200)]
    return texts, sources, [None, None, None, 7, 7, 7, *range(10, 10 + len(texts) - 6)]


@pytest.mark.parametrize("block", [256, 37])
def test_mixing(spark, block):
    texts, sources, ids = mix_docs(spark)
    docs = frame(spark, texts, source=sources, ids=ids)
    count = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += count(t)
    target = brute_targets(sizes, (3, 1, 2), 1.5, 2)
    pieces = mixing.mix(docs, (3, 1, 2), 1.5, block=block, slots_per_shard=16)
    rows = mixing.taken_words(pieces).collect()
    assert Counter((r.id, r.size) for r in rows) == Counter((i, count(t)) for i, t in zip(ids, texts))
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    taken, by_target = Counter(), defaultdict(float)
    for p in pieces.collect():
        taken[p.source] += p.n
        by_target[p.source] = p.target
        assert p.source_size == sizes[p.source]
        if p.n:
            assert len(p.text.split(" ")) == p.n <= block
    assert by_target == pytest.approx(target)
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    again = mixing.taken_words(mixing.mix(docs.repartition(5), (3, 1, 2), 1.5, block=block, with_text=False)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))
    assert mixing.taken_words(mixing.mix(docs.limit(0), (1,), 1.5)).count() == 0


def test_pieces_hold_the_words_of_their_documents(spark):
    texts, sources, _ = mix_docs(spark)
    docs = frame(spark, texts, source=sources)
    for p in mixing.mix(docs, (3, 1, 2), 1.5).where("n > 0").collect():
        assert p.text.split(" ") == WORD.findall(texts[p.id])[p["first"]:p["first"] + p.n]


def test_slots_permute_blocks(spark):
    sources = spark.createDataFrame([(0, 1000, 1700.0), (1, 5, 10.0), (2, 0, 0.0)], "s int, source_size long, target double")
    slots = mixing.draw_slots(sources, 10, 1, 4).collect()
    times = Counter((r.s, r.block) for r in slots)
    assert sum(r["take"] for r in slots if r.s == 0) == 1700 and times[1, 0] == 2 and max(times.values()) == 2
    assert sum(r["take"] for r in slots if r.s == 1) == 10 and len({r.shard for r in slots}) > 10


# ---------------------------------------------------------------- WARC

def payloads(rng):
    magic = "WARC/1.1\r\n"
    whole = f"{magic}WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    special = [None, "", magic, whole, "x" + whole + "y", magic * 5, f"a{magic}Content-Length: 99999\r\n\r\nb", "\r\n\r\n" + magic, "é\r\n\r\n", "\n", whole * 40]
    return special + ["<html>" + words(rng, rng.randint(0, 300)) + rng.choice(["", whole, magic]) for _ in range(80)]


def brute_warc(ids, html):
    groups = defaultdict(list)
    for i, h in zip(ids, html):
        groups[h or ""].append(i)
    out = []
    for i, h in zip(ids, html):
        data = (h or "").encode()
        first = max((x for x in groups[h or ""] if x is not None), default=None)
        revisit = i != first
        out.append((i, len(data), b32encode(sha1(data).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return out


@pytest.mark.parametrize("split", ["128m", "6000", "2000"])
def test_warc_round_trip(spark, tmp_path, split):
    rng = random.Random(4)
    html = payloads(rng)
    html += rng.choices(html, k=60)
    ids = [*range(len(html) - 3), None, 5, 5]
    urls = [rng.choice([None, "http://a/", "http://b/\r\nWARC/1.1\r\n"]) for _ in html]
    pages = spark.createDataFrame([(i, u, h, "x", 0) for i, u, h in zip(ids, urls, html)], "page_id long, url string, html string, digest string, id long")
    warc.write_archives(pages.coalesce(2), str(tmp_path / "w"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        records = warc.read_archives(spark, str(tmp_path / "w"))
        got = records.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(brute_warc(ids, html))
    assert all(r.digest_ok for r in got)
    assert {r.url for r in got} == {None, "http://a/", "http://b/%0D%0AWARC/1.1%0D%0A"}


def test_both_scans_split_alike_when_cores_change(spark, tmp_path):
    html = [*payloads(random.Random(8)), "WARC/1.1\r\n".join("x" * 900 for _ in range(60))]
    ids = list(range(len(html)))
    pages = spark.createDataFrame([(i, "u", h) for i, h in zip(ids, html)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    names = ("spark.sql.files.openCostInBytes", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.minPartitionNum")
    old = {n: spark.conf.get(n, None) for n in names}
    spark.conf.unset(names[2])
    spark.conf.set(names[0], "1000")
    try:
        records = warc.read_archives(spark, str(tmp_path / "w"))
        spark.conf.set(names[1], "61")  # as if executors had come between the scans
        got = records.collect()
    finally:
        for n, v in old.items():
            spark.conf.unset(n) if v is None else spark.conf.set(n, v)
    assert Counter((r.id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(brute_warc(ids, html))


def test_warc_cut_short_and_empty(spark, tmp_path):
    pages = spark.createDataFrame([(k, "u", f"page {k} " * 30) for k in range(20)], "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "w"))
    part = next((tmp_path / "w").glob("part-*"))
    data = part.read_bytes()
    (tmp_path / "cut").mkdir()
    (tmp_path / "cut" / "a.txt").write_bytes(data[:len(data) * 3 // 4])
    got = warc.read_archives(spark, str(tmp_path / "cut")).where("payload_digest is not null").count()
    assert 10 < got < 20
    warc.write_archives(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_base32(spark):
    got = spark.createDataFrame([("",), ("abc",), ("é" * 1000,)], "t string").select("t", warc.base32_sha1(F.col("t")).alias("d")).collect()
    assert all(r.d == b32encode(sha1(r.t.encode()).digest()).decode() for r in got)


# ---------------------------------------------------------------- pipeline

def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(5)
    items = [(k, words(rng, 30, 5000)) for k in range(6)]
    texts = [None, "", "123 !", "\n"]
    for k in range(60):
        lines = [words(rng, rng.randint(3, 20), 5000) for _ in range(rng.randint(1, 6))]
        if k % 7 == 0:
            lines.append(rng.choice(items)[1])
        if k % 3 == 0:
            lines.append("The line that many documents share")
        texts.append("\n".join(lines))
    texts += texts[10:14] + [texts[20] + " more", texts[21]]
    docs = frame(spark, texts, source=[rng.choice("ab") for _ in texts]).select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    read = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "line dedup", "SimHash near-dedup", "benchmark decontamination", "mixing"]

    kept = {i: t for i, t in enumerate(texts) if t and re.search(r"[^\W\d_]", t)}
    kept = {i: t for i, _, _, t in brute_lines(list(kept), list(kept.values()))}
    fp = {i: brute_fingerprint(t) for i, t in kept.items()}
    component = brute_components(sorted(set(fp.values())), 2)
    least = {}
    for i in sorted(kept):
        least.setdefault(component[fp[i]], i)
    kept = {i: kept[i] for i in least.values()}
    kept = {i: t for i, t in kept.items() if not brute_contaminated(t, items)}

    at = read
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, str(tmp_path))
        assert at.columns == docs.columns and [f.dataType for f in at.schema] == [f.dataType for f in docs.schema]
    assert {r.doc_id: (r.text, r.n_chars) for r in at.collect()} == {i: (t, len(t)) for i, t in kept.items()}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    for r in out:
        assert r.text.split(" ") == WORD.findall(kept[r.doc_id])[r.first_word:r.first_word + r.n_words]
    total = sum(len(WORD.findall(t)) for t in kept.values())
    assert abs(sum(r.n_words for r in out) - 1.5 * total) < 4


def test_block_words_are_many_and_spare_everyday_words(spark):
    from tessera.llm.queries import URL_HOST_RULES, url_block_words
    from tessera.llm.url_filter import host_rule, judge_urls, plurals, verb_forms, word_rule

    assert plurals(["lottery", "diet-pill", "brothel"]) == ["lottery", "lotteries", "diet-pill", "diet-pills", "brothel", "brothels"]
    assert verb_forms(["bet", "gamble", "track"]) == ["betting", "better", "betters", "gambling", "gambler", "gamblers", "tracking", "tracker", "trackers"]
    words = url_block_words()
    assert len(words) > 150 and not {"better", "adults"} & set(words)
    urls = ["http://free-bets.net/x", "http://a.net/tracker/1", "http://a.net/better/track", "http://GAMBLING.example.org/q", "http://a.net/spammer", "http://a.net/adults/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = judge_urls(pages, [host_rule(*r) for r in URL_HOST_RULES] + [word_rule(w) for w in words])
    got = {r["id"]: (r["verdict"], r["n_candidates"]) for r in judged.collect()}
    assert [got[i][0] for i in range(6)] == ["block", "block", "allow", "allow", "block", "allow"]  # org/ allows its hosts
    assert max(n for _, n in got.values()) < 8  # of all rules, few run
    assert judge_urls(pages, []).where("verdict = 'allow'").count() == 6
