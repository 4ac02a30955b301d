"""URL filters with DataFrame functions only.

Rules are regular expressions over ``host + path``. Every rule is indexed by the one of
its literal tokens that the fewest URLs contain; the tokens of a URL fetch candidate rules
from the index, and only those rules run their expression. A rule without a whole literal
token is indexed under the empty token, which every URL has. Verdicts are computed once per
distinct (host, path) and joined back, so repeated URLs cost one evaluation.

Tiers: host rules (the longest that fits wins) decide first; then pattern rules (any fit
blocks); then ``default``. Edge cases: a null URL or one without ``://`` has empty host and
path and gets the default unless a rule fits the empty string; repeated rows each get their row;
an empty table gives an empty result; URLs of any length are judged whole; no rules give the default; other columns of the input are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import LOWER_AZ, UPPER_AZ, checked_broadcast, lower_az

TOKEN_RE = "[a-z0-9]+"
#: More rules than this are joined by shuffle instead of broadcast.
MAX_BROADCAST_RULES = 100_000


@dataclass(frozen=True)
class UrlRule:
    """``tier`` 0: host rule, by length; 1: pattern rule."""

    name: str
    regex: str
    verdict: str
    tokens: tuple[str, ...]
    tier: int
    length: int


def _az(s: str) -> str:
    return s.translate(str.maketrans(UPPER_AZ, LOWER_AZ))


def host_rule(name: str, verdict: str) -> UrlRule:
    """``example.org/es/``: fits the host and its subdomains when the path starts with the rule's."""
    whole = name if re.search(r"[^A-Za-z0-9]$", name) else re.sub(r"[A-Za-z0-9]+$", "", name)
    host, slash, path = name.partition("/")
    return UrlRule(name, r"^([^/]*\.)?" + re.escape(_az(host)) + re.escape(slash + path), verdict,
                   tuple(dict.fromkeys(re.findall(TOKEN_RE, _az(whole)))), 0, len(name))


def word_rule(words: str, verdict: str = "block") -> UrlRule:
    """A literal such as ``cheap-pills`` standing by itself anywhere in host or path, in any case."""
    return UrlRule(words, r"(?i)(^|[^A-Za-z0-9])" + re.escape(words) + r"([^A-Za-z0-9]|$)", verdict,
                   tuple(dict.fromkeys(re.findall(TOKEN_RE, _az(words)))), 1, len(words))


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))


def url_host(url: Column) -> Column:
    return lower_az(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def url_tokens(target: Column) -> Column:
    """Distinct lower-case tokens; the empty one stands for rules without a literal."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all(lower_az(target), F.lit(f"({TOKEN_RE})"), 1)))


def plurals(nouns) -> list[str]:
    """English nouns and their regular plurals."""
    return [f for n in nouns for f in (n, re.sub("y$", "ie", n) + ("es" if re.search("(s|x|z|ch|sh)$", n) else "s"))]


def verb_forms(verbs) -> list[str]:
    """The forms in -ing, -er and -ers of English verbs: a final e dropped, a final consonant after one short vowel doubled."""
    def stem(v: str) -> str:
        return v[:-1] if v.endswith("e") else v + v[-1] if re.search(r"^[^aeiou]+[aeiou][bdgklmnpt]$", v) else v

    return [stem(v) + end for v in verbs for end in ("ing", "er", "ers")]


def rule_table(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    """The rules as rows, from literals."""
    def row(r: UrlRule) -> Column:
        return F.struct(F.lit(r.name).alias("rule"), F.lit(r.regex).alias("regex"), F.lit(r.verdict).alias("rule_verdict"),
                        F.array(*[F.lit(t) for t in r.tokens or ("",)]).alias("tokens"), F.lit(r.tier).alias("tier"), F.lit(r.length).alias("length"))

    return spark.range(1).select(F.inline(F.array(*map(row, rules)))) if rules else spark.range(0).selectExpr(
        "'' AS rule", "'' AS regex", "'' AS rule_verdict", "array('') AS tokens", "0 AS tier", "0 AS length")


def rarest_token_index(targets: DataFrame, rules: DataFrame) -> DataFrame:
    """rules x their rarest token, by the number of distinct targets that hold it."""
    of_rules = rules.select("rule", "tier", F.explode("tokens").alias("token"))
    known = checked_broadcast(of_rules.select("token").distinct(), MAX_BROADCAST_RULES)
    counts = targets.select(F.explode("tokens").alias("token")).join(known, "token").groupBy("token").count()
    rarest = of_rules.join(counts, "token", "left").groupBy("rule", "tier").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "token"))["token"].alias("token"))
    return rarest.join(rules.drop("tokens"), ["rule", "tier"])


def judge_urls(pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """id, host, path, rule (host rule or null), verdict, pattern (pattern rule or null), n_candidates."""
    spark = pages.sparkSession
    urls = pages.select(pages[id_col].alias("id"), url_host(pages[url_col]).alias("host"), url_path(pages[url_col]).alias("path"))
    distinct = urls.select("host", "path").distinct()
    targets = distinct.select("host", "path", F.concat("host", "path").alias("target"))
    targets = targets.withColumn("tokens", url_tokens(F.col("target")))
    index = checked_broadcast(rarest_token_index(targets, rule_table(spark, rules)), MAX_BROADCAST_RULES)
    fetched = targets.select("host", "path", "target", F.explode("tokens").alias("token")).join(index, "token")
    fits = F.regexp_like(F.col("target"), F.col("regex"))
    best = F.struct("length", "rule", "rule_verdict")
    judged = fetched.select("host", "path", "tier", best.alias("best"), fits.alias("fits")).groupBy("host", "path").agg(
        F.max(F.when(F.col("fits") & (F.col("tier") == 0), F.col("best"))).alias("by_host"),
        F.max(F.when(F.col("fits") & (F.col("tier") == 1), F.col("best"))).alias("by_pattern"),
        F.count("*").alias("n_candidates"))
    return urls.join(judged, ["host", "path"], "left").select(
        "id", "host", "path", F.col("by_host.rule").alias("rule"),
        F.coalesce("by_host.rule_verdict", "by_pattern.rule_verdict", F.lit(default)).alias("verdict"),
        F.col("by_pattern.rule").alias("pattern"), F.coalesce("n_candidates", F.lit(0)).alias("n_candidates"))
