"""URL rules (operator 7): host/path rules, and pattern rules found through
their rarest literal token.

Every pattern rule names the literal tokens (runs of ``a-z0-9`` bounded by
other characters) without which its expression cannot match.  The tokens are
counted over the URLs to be judged, and each rule is filed under the rarest of
its own.  A URL is cut into tokens, the tokens fetch the rules filed under
them, and only those run their regular expression.  The rule list is a
parameter (configuration, not data), so the index is a literal in the plan:
one scan to count, one to judge, no shuffle of URLs, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from campfin.llm.common import ascii_lower


@dataclass(frozen=True)
class HostRule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """``pattern`` is searched in the lower-cased URL; ``tokens`` are the
    whole tokens that any match is bound to contain."""

    name: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str = "block"


HOST_RULES = (
    HostRule("net", "/", "block"),
    HostRule("example.net", "/en/", "allow"),
    HostRule("example.com", "/de/", "block"),
    HostRule("org", "/fr/", "allow"),
)

PATTERN_RULES = (
    PatternRule("spam-farm", r"://([^/?#]*[.])?spam-farm[.]", ("spam", "farm")),
    PatternRule("cheap-pills", r"://([^/?#]*[.])?cheap-pills[.]", ("cheap", "pills")),
    PatternRule("casino-host", r"://([^/?#]*[.-])?casino[.-]", ("casino",)),
    PatternRule("xxx-host", r"://([^/?#]*[.])?xxx[.]", ("xxx",)),
    PatternRule("tracker-path", r"://[^/?#]*/(ads|track)/pixel([./?#]|$)", ("pixel",)),
    PatternRule("feed-copy", r"[?&]utm_source=feed&utm_medium=copy([&#]|$)",
                ("utm", "source", "feed", "medium", "copy")),
    PatternRule("session-id", r"[?&](phpsessid|jsessionid|sid)=[0-9a-f]{16,}&ref=spam([&#]|$)",
                ("ref", "spam")),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for a null url or one without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    head = F.substring_index(url, "://", 1)
    return F.when(F.instr(url, "://") > 0, F.substring(url, F.length(head) + 4, F.length(url))
                  ).otherwise(F.lit(""))


def url_tokens(url: Column) -> Column:
    return F.array_distinct(F.split(ascii_lower(F.coalesce(url, F.lit(""))), "[^a-z0-9]+"))


def _struct_array(items: list[Column], ddl: str) -> Column:
    return F.array(*items) if items else F.array().cast(f"array<{ddl}>")


def host_verdict(host: Column, path: Column, rules) -> Column:
    """The longest fitting host rule as ``struct(len, rule, verdict)``, else
    null.  A host is looked up by as many last labels as the longest rule host
    has, so a host of any length costs the same."""
    if not rules:
        return F.lit(None).cast("struct<len:int,rule:string,verdict:string>")
    by_host: dict[str, list[HostRule]] = {}
    for r in rules:
        by_host.setdefault(r.host, []).append(r)
    index = F.create_map(*[x for h, rs in sorted(by_host.items()) for x in (
        F.lit(h), F.array(*[F.struct(F.lit(r.path).alias("path"),
                                     F.lit(len(r.name)).alias("len"),
                                     F.lit(r.name).alias("rule"),
                                     F.lit(r.verdict).alias("verdict")) for r in rs]))])
    deepest = max(r.host.count(".") + 1 for r in rules)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.lit(deepest)),
        lambda n: F.call_function("substring_index", host, F.lit("."), -n))
    found = F.flatten(F.filter(F.transform(F.array_distinct(suffixes), lambda s: index[s]),
                               lambda a: a.isNotNull()))
    fits = F.filter(found, lambda r: F.startswith(path, r["path"]))
    return F.array_max(F.transform(
        fits, lambda r: F.struct(r["len"].alias("len"), r["rule"].alias("rule"),
                                 r["verdict"].alias("verdict"))))


def token_counts(pages: DataFrame, rules, url_col: str = "url") -> dict[str, int]:
    """How many URLs hold each literal token of the rules (one row per such
    token comes back: bounded by the rule list)."""
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return {}
    toks = pages.select(F.explode(F.array_intersect(
        url_tokens(F.col(url_col)), F.array(*[F.lit(t) for t in wanted]))).alias("token"))
    return {r["token"]: r["n"] for r in
            toks.groupBy("token").agg(F.count("*").alias("n")).collect()}


def file_rules(rules, counts: dict[str, int]) -> dict[str, list[PatternRule]]:
    """Each rule under its rarest token (ties: the smaller token)."""
    index: dict[str, list[PatternRule]] = {}
    for r in rules:
        rarest = min(r.tokens, key=lambda t: (counts.get(t, 0), t))
        index.setdefault(rarest, []).append(r)
    return index


def fired_patterns(url: Column, index: dict[str, list[PatternRule]]) -> Column:
    """Names and verdicts of the pattern rules that match, by name."""
    ddl = "struct<name:string,pattern:string,verdict:string>"
    if not index:
        return F.array().cast(f"array<{ddl}>")
    filed = F.create_map(*[x for t, rs in sorted(index.items()) for x in (
        F.lit(t), F.array(*[F.struct(F.lit(r.name).alias("name"),
                                     F.lit(r.pattern).alias("pattern"),
                                     F.lit(r.verdict).alias("verdict")) for r in rs]))])
    known = F.array(*[F.lit(t) for t in sorted(index)])
    candidates = F.flatten(F.transform(
        F.array_intersect(url_tokens(url), known), lambda t: filed[t]))
    low = ascii_lower(F.coalesce(url, F.lit("")))
    return F.array_sort(F.filter(candidates, lambda r: F.regexp_like(low, r["pattern"])))


def judge_urls(pages: DataFrame, host_rules=HOST_RULES, pattern_rules=PATTERN_RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, host, path, rule, verdict, patterns.

    ``rule`` is the longest fitting host rule (host + path), else null; of
    equally long ones the greatest in text order, and of equal ones the greater
    verdict.  The verdict is that rule's; without one it is ``block`` when a
    matching pattern rule says so and ``allow`` otherwise.  ``patterns`` names
    all matching pattern rules.

    Null or scheme-less urls: empty host and path, no rule, verdict by the
    patterns (usually allow).  Very long urls are read whole.  Repeated rows
    are judged alike and kept; an empty table gives no rows; other columns are not read.
    """
    index = file_rules(pattern_rules, token_counts(pages, pattern_rules, url_col))
    src = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("_url"))
    parts = src.select(id_col, "_url", host_of(F.col("_url")).alias("host"),
                       path_of(F.col("_url")).alias("path"))
    parts = parts.withColumns({
        "host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    judged = parts.select(
        id_col, "host", "path",
        host_verdict(F.col("host"), F.col("path"), host_rules).alias("_best"),
        fired_patterns(F.col("_url"), index).alias("_fired"))
    blocked = F.exists("_fired", lambda r: r["verdict"] == "block")
    return judged.select(
        id_col, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce(F.col("_best.verdict"),
                   F.when(blocked, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.array_join(F.transform("_fired", lambda r: r["name"]), ",").alias("patterns"))
