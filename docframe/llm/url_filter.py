"""URL filter: allow and block rules by host suffix and path prefix, then a weighted vocabulary.

The vocabulary is matched with an Aho-Corasick automaton over the whole URL after its scheme. A hit counts only between
boundaries (no ASCII letter on either side). A strict term rejects alone; soft terms reject from ``soft_limit`` distinct
ones on. Rows are judged one by one without a shuffle, so hot hosts and repeated URLs cost nothing extra.

Defined results: a null URL, or one without ``://``, has an empty host and path and no rule; a null or empty URL has no
hits and is allowed; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docframe.llm.common import UPPER, ascii_lower, read_table

#: Terms of the default vocabulary.
STRICT = ("camgirl", "escorts", "hardcore", "hentai", "milf", "porn", "porno", "pornstar", "sexcam", "xvideos", "xxx")
SOFT = (
    "adult", "babe", "bet", "betting", "bingo", "casino", "cialis", "dating", "erotic", "fetish", "gambling", "jackpot",
    "lingerie", "naked", "nude", "payday", "pharma", "pills", "poker", "sex", "sexy", "slots", "torrent", "viagra", "warez",
)


@dataclass(frozen=True)
class UrlVocabulary:
    strict: Sequence[str] = STRICT
    soft: Sequence[str] = SOFT
    soft_limit: int = 2


@dataclass(frozen=True)
class UrlRule:
    """``action`` is allow or block; ``prefix`` is a host, a slash and the start of a path, such as ``example.com/en/``."""

    action: str
    prefix: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.prefix.partition("/")[2]


#: The rules of the registered query.
RULES = (
    UrlRule("block", "com/en/"),
    UrlRule("allow", "example.com/en/7"),
    UrlRule("allow", "net/de/"),
    UrlRule("block", "example.net/de/8"),
    UrlRule("block", "org/es/"),
)


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule], field: str) -> Column:
    """``field`` (prefix or action) of the longest rule that fits, else null. Among equal lengths the longer host wins."""
    found = F
    for rule in sorted(rules, key=lambda r: (-len(r.prefix), -len(r.host), r.prefix)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = found.when(fits, F.lit(getattr(rule, field)))
    return F.lit(None).cast("string") if found is F else found.otherwise(F.lit(None).cast("string"))


def automaton(vocabulary: UrlVocabulary):
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, terms in (("strict", vocabulary.strict), ("soft", vocabulary.soft)):
        for term in terms:
            a.add_word(term, (kind, term))
    if len(a):
        a.make_automaton()
    return a


def count_terms(text: str, a) -> tuple[int, int]:
    """Distinct strict and soft terms of ``text`` (in lower case) between boundaries."""
    hits = set()
    for end, (kind, term) in a.iter(text) if len(a) else ():
        start = end - len(term)
        if (start < 0 or not "a" <= text[start] <= "z") and (end + 1 == len(text) or not "a" <= text[end + 1] <= "z"):
            hits.add((kind, term))
    strict = sum(kind == "strict" for kind, _ in hits)
    return strict, len(hits) - strict


def term_counts(url: Column, vocabulary: UrlVocabulary) -> Column:
    """struct(strict, soft): numbers of distinct terms found in the URL."""
    lower = str.maketrans(UPPER, UPPER.lower())

    @F.pandas_udf("strict int, soft int")
    def counts(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        a = automaton(vocabulary)
        for urls in batches:
            found = [count_terms((u or "").partition("://")[2].translate(lower) if "://" in (u or "") else (u or "").translate(lower), a) for u in urls]
            yield pd.DataFrame(found, columns=["strict", "soft"])

    return counts(url)


def judge_urls(df: DataFrame, url_col: str = "url", rules: Sequence[UrlRule] = RULES, vocabulary: UrlVocabulary = UrlVocabulary(), keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus host, path, rule, verdict, strict_terms, soft_terms; one row for each row of ``df``."""
    base = df.select(*[F.col(k) for k in keep], F.col(url_col).alias("__url"))
    parts = base.withColumns({"host": url_host(F.col("__url")), "path": url_path(F.col("__url")), "__terms": term_counts(F.col("__url"), vocabulary)})
    host, path = F.col("host"), F.col("path")
    rejects = (F.col("__terms.strict") >= 1) | (F.col("__terms.soft") >= vocabulary.soft_limit)
    return parts.select(
        *[F.col(k) for k in keep],
        host,
        path,
        fitting_rule(host, path, rules, "prefix").alias("rule"),
        F.coalesce(fitting_rule(host, path, rules, "action"), F.when(rejects, "block").otherwise("allow")).alias("verdict"),
        F.col("__terms.strict").alias("strict_terms"),
        F.col("__terms.soft").alias("soft_terms"),
    )


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(read_table(spark, sf_dir, "pages"), keep=["page_id"])


def _sql() -> str:
    def hits(terms: Sequence[str]) -> str:
        inside = ", ".join(f"'{t}'" for t in terms)
        return f"CAST(len(list_filter([{inside}], lambda t: regexp_matches(u, '(^|[^a-z])' || t || '($|[^a-z])'))) AS INTEGER)"

    def case(field: str) -> str:
        ordered = sorted(RULES, key=lambda r: (-len(r.prefix), -len(r.host), r.prefix))
        return "CASE " + " ".join(f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{getattr(r, field)}'" for r in ordered) + " END"

    low = f"'{UPPER}', '{UPPER.lower()}'"
    return f"""
    WITH parts AS (
      SELECT page_id,
             coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {low}), '') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
             translate(CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE coalesce(url, '') END, {low}) AS u
      FROM pages),
    counted AS (SELECT *, {hits(STRICT)} AS strict_terms, {hits(SOFT)} AS soft_terms FROM parts)
    SELECT page_id, host, path, {case("prefix")} AS rule,
           coalesce({case("action")}, CASE WHEN strict_terms >= 1 OR soft_terms >= 2 THEN 'block' ELSE 'allow' END) AS verdict,
           strict_terms, soft_terms
    FROM counted"""


QUERIES = {"op1_url_filter": op1_url_filter}
ORACLE_SQL = {"op1_url_filter": _sql()}
