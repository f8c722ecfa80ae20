"""URL filters: rules indexed by their rarest literal token; a URL's tokens fetch candidates, and only those are tested.

A rule is a host and a path (it fits the host and its subdomains, where the URL's path starts with the rule's) or
a regular expression with its literal tokens. Tokens are runs of `[a-z0-9]` of the lower-cased URL. Of a rule's
literal tokens, the one in the fewest URLs of the table indexes it. The candidates' regular expressions run over
host and path joined; of the host rules that fit, the longest holds, and without one any pattern's verdict holds, else
`allow`.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; path: from there up to `?`, `#` or the
end. A null URL, or one without `://`, has an empty host and path.

Up to INLINE_RULES rules are looked up inside a projection, without a shuffle; more are joined by token.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

INLINE_RULES = 2000
_RULE = "struct<name:string,verdict:string,regex:string,size:int,pattern:boolean>"


@dataclass(frozen=True)
class Rule:
    name: str
    verdict: str
    regex: str
    tokens: tuple[str, ...]
    pattern: bool = False


def host_rule(verdict: str, host: str, path: str) -> Rule:
    """Fits `host` and its subdomains, for paths that start with `path`."""
    tokens = tuple(dict.fromkeys(t for t in re.split(r"[^a-z0-9]+", f"{host} {path[: path.rfind('/') + 1]}".lower()) if t))
    return Rule(host + path, verdict, rf"^(?:[^/]*\.)?{_quoted(host + path)}", tokens)


def pattern_rule(verdict: str, token: str) -> Rule:
    """Fits URLs with `token` as a whole token, in the host or the path."""
    return Rule(token, verdict, rf"(?i)(?:^|[^a-z0-9]){_quoted(token)}(?:[^a-z0-9]|$)", (token,), True)


def _quoted(text: str) -> str:
    return re.sub(r"([^A-Za-z0-9/ ])", r"\\\1", text)


# Fixed values.
HOST_RULES = (
    host_rule("allow", "com", "/"),
    host_rule("block", "example.com", "/en/"),
    host_rule("allow", "www.example.com", "/en/"),
    host_rule("block", "net", "/es/"),
    host_rule("block", "net", "/fr/"),
)
PATTERN_TOKENS = ("casino", "poker", "porn", "xxx", "viagra", "torrent", "malware", "phishing")
RULES = HOST_RULES + tuple(pattern_rule("block", t) for t in PATTERN_TOKENS)


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def url_tokens(host: Column, path: Column) -> Column:
    return F.array_distinct(F.split(F.lower(F.concat_ws(" ", host, path)), "[^a-z0-9]+"))


def rarest_tokens(pages: DataFrame, rules: tuple[Rule, ...]) -> dict[str, list[Rule]]:
    """Rules by the literal token that the fewest rows of pages (host, path) hold: one row a token reaches the driver."""
    known = sorted({t for r in rules for t in r.tokens})
    held = F.array_intersect(url_tokens(F.col("host"), F.col("path")), F.array(*[F.lit(t) for t in known]).cast("array<string>"))
    counts = {r["token"]: r["n"] for r in pages.select(F.explode(held).alias("token")).groupBy("token").agg(F.count("*").alias("n")).collect()}
    index: dict[str, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.tokens, key=lambda t: (counts.get(t, 0), t)), []).append(r)
    return index


def _literal(r: Rule) -> Column:
    return F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"), F.lit(r.regex).alias("regex"), F.lit(len(r.name)).alias("size"), F.lit(r.pattern).alias("pattern")).cast(_RULE)


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, inline: int = INLINE_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for each row; rule is null where no host rule fits."""
    if any(not r.tokens for r in rules):
        raise ValueError("a rule needs a literal token")
    host, path = parts(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    index = rarest_tokens(pages, rules)
    address = F.concat("host", "path")
    if len(rules) <= inline:
        lists = [F.array(*[_literal(r) for r in own]) for own in index.values()]
        table = F.create_map(*[x for t, own in zip(index, lists) for x in (F.lit(t), own)])
        candidates = F.flatten(F.transform(F.array_intersect(url_tokens(F.col("host"), F.col("path")), F.map_keys(table)), lambda t: table[t]))
        fitting = pages.withColumn("address", address).withColumn("fits", F.filter(candidates, lambda r: F.rlike(F.col("address"), r["regex"])))
    else:
        spark = pages.sparkSession
        rows = [(t, (r.name, r.verdict, r.regex, len(r.name), r.pattern)) for t, own in index.items() for r in own]
        by_token = spark.createDataFrame(rows, f"token string, candidate {_RULE}")
        found = (
            pages.select(F.xxhash64("host", "path").alias("key"), "host", "path").distinct()
            .select("host", "path", F.explode(url_tokens(F.col("host"), F.col("path"))).alias("token"))
            .join(by_token, "token").where(F.rlike(address, F.col("candidate.regex")))
            .groupBy("host", "path")
            .agg(F.min_by("candidate", F.struct("candidate.pattern", F.when(F.col("candidate.pattern"), 0).otherwise(-F.col("candidate.size")), "candidate.name")).alias("best"))
        )
        fitting = pages.join(found, ["host", "path"], "left").withColumn("fits", F.array_compact(F.array("best")))
    hosts = F.filter("fits", lambda r: ~r["pattern"])
    longest = F.element_at(F.array_sort(F.transform(hosts, lambda r: F.struct((-r["size"]).alias("k"), r["name"].alias("name"), r["verdict"].alias("verdict")))), 1)
    best = F.when(F.size(hosts) > 0, longest)
    by_pattern = F.when(F.size("fits") > 0, F.array_sort(F.transform("fits", lambda r: F.struct(r["name"].alias("name"), r["verdict"].alias("verdict"))))[0]["verdict"]).otherwise("allow")
    return fitting.select("page_id", "host", "path", best["name"].alias("rule"), F.coalesce(best["verdict"], by_pattern).alias("verdict"))


def _sql() -> str:
    """The fixed rules as a query over the table pages."""
    tokens = " or ".join(f"regexp_matches(lower(host || path), '(^|[^a-z0-9]){t}([^a-z0-9]|$)')" for t in PATTERN_TOKENS)
    return rf"""
with cut as (
  select page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
ruled as (
  select *, case
    when ('.' || host) like '%.www.example.com' and path like '/en/%' then 'www.example.com/en/'
    when ('.' || host) like '%.example.com' and path like '/en/%' then 'example.com/en/'
    when ('.' || host) like '%.net' and path like '/es/%' then 'net/es/'
    when ('.' || host) like '%.net' and path like '/fr/%' then 'net/fr/'
    when ('.' || host) like '%.com' and path like '/%' then 'com/' end as rule
  from cut)
select page_id, host, path, rule,
  case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
    when {tokens} then 'block' else 'allow' end as verdict
from ruled"""


ORACLE = _sql()
