"""Registered queries of the training-data operators: each applies its operator, with
production parameters, to the whole table and derives the contract's columns."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import WORD_RE, Query, table
from tessera.session import scratch_path

URL_HOST_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: General terms of adult, gambling, pharmacy-spam, credit-spam, piracy and tracking sites; with their regular forms each is a rule.
URL_BLOCK_NOUNS = (
    "adult", "porn", "porno", "pornstar", "xxx", "nude", "escort", "fetish", "camgirl", "hookup", "stripper", "milf", "hentai", "onlyfan", "sexcam", "sextoy", "brothel",
    "casino", "bet", "roulette", "blackjack", "jackpot", "lottery", "slotmachine", "bookie", "bookmaker", "sportsbook", "baccarat", "bingo", "freespin", "wager",
    "viagra", "cialis", "levitra", "xanax", "tramadol", "steroid", "diet-pill", "cheap-pill", "online-pharmacy", "weight-loss-pill",
    "payday-loan", "cash-advance", "quick-loan", "bad-credit-loan", "debt-relief", "replica-watch", "counterfeit", "fake-id", "essay-mill",
    "warez", "torrent", "keygen", "serial-key", "crackz", "nulled", "malware", "spyware", "adware", "ransomware", "botnet", "scam", "spam",
    "adserver", "doubleclick", "clickbait", "popunder", "popup-ad", "banner-ad", "ads", "linkfarm", "spamdexing", "webbug",
)
URL_BLOCK_VERBS = ("bet", "gamble", "wager", "phish", "spam", "scam", "spoof", "track", "retarget", "cloak", "typosquat", "skim", "keylog", "cryptojack", "carding")
#: Forms that are everyday words.
URL_NOT_BLOCKED = ("better", "betters", "adults", "adses")
URL_BLOCK_PHRASES = ("casino-win", "cheap-pills", "free-money", "get-rich", "weight-loss", "work-from-home")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.language_id import held_out, identify, label_languages

    docs = table(spark, sf_dir, "documents")
    labelled = label_languages(docs.select("doc_id", "text"), identify(docs))
    return labelled.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"),
                           F.size("spans").cast("long").alias("n_spans"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.mixing import mix, taken_words

    pieces = mix(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, max_repeat=2, with_text=False)
    return taken_words(pieces).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.warc import read_archives, write_archives

    path = scratch_path(spark, "llm", f"warc-{uuid.uuid4().hex}")
    write_archives(table(spark, sf_dir, "pages"), path, min_revisit_bytes=0)
    records = read_archives(spark, path)
    return records.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select(F.col("id").alias("doc_id"), hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.suffix_dedup import remove_repeats

    kept = remove_repeats(table(spark, sf_dir, "documents"), min_bytes=200)
    return kept.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.url_filter import host_rule, judge_urls, word_rule

    rules = [host_rule(*r) for r in URL_HOST_RULES] + [word_rule(w) for w in url_block_words()]
    judged = judge_urls(table(spark, sf_dir, "pages"), rules)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "pattern")


def url_block_words() -> list[str]:
    from tessera.llm.url_filter import plurals, verb_forms

    words = [*plurals(URL_BLOCK_NOUNS), *verb_forms(URL_BLOCK_VERBS), *URL_BLOCK_PHRASES]
    return [w for w in dict.fromkeys(words) if w not in URL_NOT_BLOCKED]


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.lm_scoring import score_documents

    return score_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.line_dedup import apply_bitmaps, keep_bitmaps

    docs = table(spark, sf_dir, "documents")
    kept = apply_bitmaps(docs, keep_bitmaps(docs))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.decontaminate import mark_documents

    marked = mark_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return marked.withColumnRenamed("id", "doc_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.quality import document_stats, judge_documents

    judged = judge_documents(document_stats(table(spark, sf_dir, "documents")))
    return judged.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "n_removed_words")


SPELLING_SLIP = 97


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.spelling import count_words, variant_groups, words_of

    docs = table(spark, sf_dir, "documents")
    words = words_of(docs.withColumn("doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    h = F.crc32(F.concat("id", F.lit(":"), "word").cast("binary"))
    at = (h % F.char_length("word")).cast("int")
    slipped = F.concat(F.left("word", at), F.substring("word", at + 2, F.char_length("word")))
    words = words.select(F.when(h % SPELLING_SLIP == 0, slipped).otherwise(F.col("word")).alias("word"))
    return variant_groups(count_words(words, min_length=5, min_count=3), ratio=2)


def op12_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers

    from tessera.llm.token_files import read_files, write_files

    path = scratch_path(spark, "llm", f"token-files-{uuid.uuid4().hex}")
    write_files(table(spark, sf_dir, "documents"), path, tokenizer or public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_files(spark, path).withColumnRenamed("id", "doc_id")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every document whose crc32 of the id ends in 0, the words from one on give way to repetitions of a stretch of them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = docs.select("doc_id", "text", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD_RE), F.lit(0))).alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words").cast("long")
    rows = chosen.select("doc_id", "text", F.when(n > 0, F.col("words")).alias("words"), F.when(n > 0, n).alias("n"), "g")
    rows = rows.withColumn("a", F.col("g") % F.col("n"))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    source = F.transform(F.sequence(F.lit(0).cast("long"), F.col("n") - 1), lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")))
    repeated = F.array_join(F.transform(source, lambda i: F.get("words", i.cast("int"))), " ")
    return rows.select("doc_id", F.when(F.col("n").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tessera.llm.periodic_runs import find_runs, strongest, written

    found = find_runs(repeat_tails(table(spark, sf_dir, "documents")), min_length=24, min_periods=3)
    best = found.select("id", "runs", "collapsed", strongest(F.col("runs")).alias("best"))
    return best.select(F.col("id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                       F.sha2(written(F.col("runs")), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_warc": op3_warc,
    "op4_simhash": op4_simhash,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_url_filter": op6_url_filter,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_quality": op10_quality,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_files": op12_token_files,
    "op13_periodic_runs": op13_periodic_runs,
}
