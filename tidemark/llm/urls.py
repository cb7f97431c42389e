"""URL filters: host and path rules, then a weighted vocabulary found by one Aho-Corasick scan.

A rule fits its host and every subdomain when the URL's path starts with the
rule's path; the longest fitting rule decides.  All other URLs are judged by
vocabulary: a term counts where it is bounded by characters other than letters
and digits, each distinct term once; one strict term or ``soft_limit`` distinct
soft terms reject.

Defined cases: a null URL or one without ``://`` has an empty host and path and
no rule; its text is still searched (null has no terms).
"""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ship

STRICT_TERMS = ("adult", "casino", "escort", "gambling", "hentai", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT_TERMS = (
    "ads", "bet", "bets", "bonus", "cheap", "click", "crack", "download", "farm", "free", "jackpot", "loan", "pills", "poker",
    "popup", "prize", "sex", "slots", "track", "win",
)
SOFT_LIMIT = 2
# (verdict, host, path) of the standing rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL as text; both empty if it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, strict=STRICT_TERMS, soft=SOFT_TERMS, soft_limit: int = SOFT_LIMIT) -> DataFrame:
    """``pages`` with host, path, rule, verdict and the numbers of distinct strict and soft terms."""
    ship(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    found = pages.withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith(f".{rule_host}")) & F.col("path").startswith(rule_path)
        rule = F.when(fits, F.lit(rule_host + rule_path)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    found = found.withColumn("__terms", _term_counter(tuple(strict), tuple(soft))(F.col("url")))
    rejected = (F.col("__terms.strict") >= 1) | (F.col("__terms.soft") >= soft_limit)
    return found.withColumns(
        {
            "rule": rule,
            "verdict": F.coalesce(verdict, F.when(rejected, "block").otherwise("allow")),
            "strict_terms": F.col("__terms.strict"),
            "soft_terms": F.col("__terms.soft"),
        }
    ).drop("__terms")


def _term_counter(strict: tuple[str, ...], soft: tuple[str, ...]):
    vocabulary = [(t, 0) for t in strict] + [(t, 1) for t in soft if t not in strict]
    held = []

    @F.pandas_udf("strict int, soft int")
    def count(urls: pd.Series) -> pd.DataFrame:
        if not held:
            automaton = ahocorasick.Automaton()
            for term, kind in vocabulary:
                automaton.add_word(term, (len(term), kind, term))
            automaton.make_automaton()
            held.append(automaton)
        rows = []
        for url in urls:
            text = (url or "").encode("utf-8", "surrogatepass").lower().decode("latin-1")
            kinds: tuple[set, set] = (set(), set())
            for end, (length, kind, term) in held[0].iter(text) if text else ():
                if not _joins(text, end - length) and not _joins(text, end + 1):
                    kinds[kind].add(term)
            rows.append((len(kinds[0]), len(kinds[1])))
        return pd.DataFrame(rows, columns=["strict", "soft"])

    return count


def _joins(text: str, at: int) -> bool:
    """Whether the character there is an ASCII letter or digit and so continues a word."""
    return 0 <= at < len(text) and text[at] in "abcdefghijklmnopqrstuvwxyz0123456789"
