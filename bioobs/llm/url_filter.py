"""URL filters: host and path rules, then a list behind a blocked Bloom filter.

A url's host and path choose the longest rule that fits. Without a rule the list
decides: the canonical url is tested in a blocked Bloom filter (each url sets
eight bits of one 256-bit block, so a test reads one block), and what passes is
joined with the list itself, which removes the false positives. Only possible hits
are moved for that join, as distinct canonical urls. Everything is DataFrame
functions.

Defined cases: a missing url, or one without ``://``, has an empty host and path,
fits no rule, is never listed and is allowed. Missing and empty entries of the
list are ignored, repeated ones count once; an empty list blocks nothing. Columns
other than the two named are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from bioobs.operators.joins import broadcast_if_small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS_PER_URL = 16
BLOCK_BITS = 256


@dataclass(frozen=True)
class UrlRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without a last ``/`` or ``.html``, and the query's
    parameters in order, without those that only track. No scheme, no fragment. NULL
    if the url has no host."""
    host, path = url_parts(url)
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(
        F.filter(F.split(query, "&"), lambda p: ~p.rlike(r"^(utm_[^=]*|ref)(=|$)") & (p != ""))
    )
    text = F.concat(
        F.regexp_replace(host, r"^www\.", ""),
        F.regexp_replace(path, r"(\.html|/)$", ""),
        F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit("")),
    )
    return F.when(host != "", text)


def rule_of(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else NULL."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    name = verdict = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def _bits(url: Column) -> list[Column]:
    """Four words of a block, each with two bits of the url."""
    second = F.xxhash64(url, F.lit(1))
    one = F.lit(1).cast("long")
    spot = [F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(8)]
    shifted = [F.call_function("shiftleft", one, s) for s in spot]
    return [shifted[2 * k].bitwiseOR(shifted[2 * k + 1]) for k in range(4)]


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(blocks))


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """``block, w0..w3`` for the distinct urls of ``listed(canonical)``."""
    words = _bits(F.col("canonical"))
    return (
        listed.select(_block(F.col("canonical"), blocks).alias("block"), *[w.alias(f"w{k}") for k, w in enumerate(words)])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(4)])
    )


def judge_urls(
    pages: DataFrame, listed: DataFrame, rules: list[UrlRule], id_column: str = "page_id", url_column: str = "url"
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``listed`` has a column ``canonical``. The filter's size follows the length of
    the list; it and the list are broadcast only behind a check of their size.
    """
    listed = listed.select("canonical").where(F.col("canonical") != "").distinct()
    blocks = max(1, -(-listed.count() * BITS_PER_URL // BLOCK_BITS))
    host, path = url_parts(pages[url_column])
    parts = pages.select(
        pages[id_column].alias("page_id"), host.alias("host"), path.alias("path"), canonical(pages[url_column]).alias("canonical")
    )
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = parts.select("*", rule.alias("rule"), verdict.alias("by_rule"))
    open_rows = judged.where(F.col("rule").isNull() & F.col("canonical").isNotNull())
    ruled = judged.where(F.col("rule").isNotNull() | F.col("canonical").isNull())

    bloom = broadcast_if_small(bloom_blocks(listed, blocks))
    tested = open_rows.withColumn("block", _block(F.col("canonical"), blocks)).join(bloom, "block", "left")
    passes = F.lit(True)
    for k, word in enumerate(_bits(F.col("canonical"))):
        passes = passes & (F.coalesce(F.col(f"w{k}"), F.lit(0)).bitwiseAND(word) == word)
    tested = tested.withColumn("possible", passes)
    hits = (
        tested.where("possible")
        .select("canonical")
        .distinct()
        .join(listed, "canonical", "left_semi")
        .withColumn("hit", F.lit(True))
    )
    decided = tested.where("possible").join(broadcast_if_small(hits), "canonical", "left")
    columns = ["page_id", "host", "path", "rule"]
    return (
        ruled.select(*columns, F.coalesce("by_rule", F.lit("allow")).alias("verdict"))
        .unionByName(tested.where(~F.col("possible")).select(*columns, F.lit("allow").alias("verdict")))
        .unionByName(
            decided.select(*columns, F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow")).alias("verdict"))
        )
    )


# fixed values: the rules of the query, and the words of hosts whose pages it lists
QUERY_RULES = [
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
]
LISTED_HOSTS = r"(^|[.-])(ads|adult|bets|casino|pills|spam)[.-]"


def listed_from_pages(pages: DataFrame, pattern: str = LISTED_HOSTS, url_column: str = "url") -> DataFrame:
    """The list the query uses: canonical urls of pages on unwanted hosts."""
    host, _ = url_parts(pages[url_column])
    return pages.where(host.rlike(pattern)).select(canonical(pages[url_column]).alias("canonical"))


def judge_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge_urls(pages, listed_from_pages(pages), QUERY_RULES)


_HOST = f"translate(regexp_extract(rest, '^[^/?#]*', 0), '{UPPER}', '{LOWER}')"
_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.name}'"
    for r in sorted(QUERY_RULES, key=lambda r: -len(r.name))
)
_VERDICTS = " ".join(f"WHEN '{r.name}' THEN '{r.verdict}'" for r in QUERY_RULES)
ORACLE = f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
    list_sort(list_filter(string_split(regexp_extract(coalesce(url, ''), '^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref)(=|$)'))) AS kept
  FROM cut
), named AS (
  SELECT page_id, host, path, CASE {_FITS} END AS rule,
    CASE WHEN host <> '' THEN regexp_replace(host, '^www\\.', '') || regexp_replace(path, '(\\.html|/)$', '')
      || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS canonical
  FROM parts
)
SELECT page_id, host, path, rule,
  CASE rule {_VERDICTS} ELSE CASE WHEN canonical IN (
    SELECT canonical FROM named WHERE regexp_matches(host, '{LISTED_HOSTS}') AND canonical IS NOT NULL
  ) THEN 'block' ELSE 'allow' END END AS verdict
FROM named
"""
