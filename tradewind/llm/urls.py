"""URL filters: pattern rules found by their rarest literal token.

A rule is a regular expression over host and path, with literals: tokens (runs of letters and
digits) that every fitting URL holds. A rule is indexed under the one of its literals that is
rarest among all URLs. The tokens of a URL fetch candidate rules by an equi-join, and only the
candidates' expressions run.

Listed rules (a host with its subdomains, and the start of a path) come before pattern rules: of
those that fit, the longest decides; then block before allow, then the name. Without one, a URL
that fits any blocking pattern is blocked, all others are allowed.

Equal URLs are judged once. A URL that is NULL or has no ``://`` has an empty host and path, which
no rule fits.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.operators.lineage import written

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``pattern`` runs over host and path; ``literals`` are whole tokens, in lower case."""

    name: str
    verdict: str
    pattern: str
    literals: tuple[str, ...]
    listed: bool = False

    def __post_init__(self):
        if self.verdict not in (ALLOW, BLOCK):
            raise ValueError(f"{self.name}: a rule allows or blocks")
        if not self.literals or any(not _TOKEN.fullmatch(token) for token in self.literals):
            raise ValueError(f"{self.name}: a rule needs literal tokens")


def listed_rule(name: str, verdict: str) -> Rule:
    """A rule from ``host/path``: that host and its subdomains, paths that start like this."""
    host, slash, path = name.partition("/")
    literals = _TOKEN.findall(host) + [
        token for token in re.findall("(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", (slash + path).lower())]
    return Rule(name, verdict, rf"^([^/]*\.)?{re.escape(host)}{re.escape(slash + path)}",
                tuple(dict.fromkeys(literals)), listed=True)


# The listed rules.
LISTED = (listed_rule("net/", BLOCK), listed_rule("example.net/en/", ALLOW),
          listed_rule("example.com/de/", BLOCK), listed_rule("org/fr/", ALLOW))

# Pages that hold no prose.
PATTERNS = (
    Rule("advertising host", BLOCK, r"^([^/]*\.)?ads\.", ("ads",)),
    Rule("tracking host", BLOCK, r"^([^/]*\.)?tracker\.", ("tracker",)),
    Rule("casino host", BLOCK, r"^([^/]*[.-])?casino[.-][^/]*", ("casino",)),
    Rule("adult host", BLOCK, r"^([^/]*[.-])?porn[.-][^/]*", ("porn",)),
    Rule("log-in page", BLOCK, r"/login(/|\.[a-z]+|$)", ("login",)),
    Rule("sign-up page", BLOCK, r"/signup(/|\.[a-z]+|$)", ("signup",)),
    Rule("shopping cart", BLOCK, r"/cart(/|\.[a-z]+|$)", ("cart",)),
    Rule("checkout", BLOCK, r"/checkout(/|\.[a-z]+|$)", ("checkout",)),
    Rule("administration", BLOCK, r"/wp-admin(/|$)", ("wp", "admin")),
    Rule("tag listing", BLOCK, r"/tag/[^/]+/page/[0-9]+(/|$)", ("tag", "page")),
    Rule("session in path", BLOCK, r";jsessionid=[A-Za-z0-9]+", ("jsessionid",)),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def _tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(
        F.translate(subject, _UPPER, _LOWER), F.lit("([a-z0-9]+)"), 1))


def rule_index(subjects: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The rules, each with the literal (``token``) that the fewest of the subjects hold."""
    spark = subjects.sparkSession
    table = spark.createDataFrame(
        [(i, r.name, r.verdict, r.pattern, r.listed, len(r.name) if r.listed else 0,
          list(r.literals)) for i, r in enumerate(rules)],
        "number int, name string, verdict string, pattern string, listed boolean, size int, "
        "literals array<string>")
    literals = table.select("number", F.explode("literals").alias("token"))
    counts = (subjects.select(F.explode(_tokens(F.col("subject"))).alias("token"))
              .join(literals.select("token").distinct(), "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("n")))
    rarest = (literals.join(counts, "token", "left").groupBy("number").agg(F.min_by(
        "token", F.struct(F.coalesce("n", F.lit(0)), -F.length("token"), "token")).alias("token")))
    return table.drop("literals").join(rarest, "number")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = LISTED + PATTERNS, url: str = "url",
          row_id: str = "page_id") -> DataFrame:
    """(row_id, host, path, rule, verdict, pattern) of every row.

    ``rule`` is the listed rule that decided, ``pattern`` the pattern rule that blocks, if any.
    """
    host, path = host_and_path(F.col(url).cast("string"))
    rows = pages.select(F.col(row_id).alias("row_id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("subject", F.concat("host", "path"))
    subjects = written(rows.select("subject").distinct())
    index = rule_index(subjects, rules)
    candidates = subjects.select("subject", F.explode(_tokens(F.col("subject"))).alias("token"))
    fitting = candidates.join(index, "token").where(
        F.call_function("rlike", F.col("subject"), F.col("pattern")))
    decided = fitting.groupBy(F.col("subject").alias("_subject")).agg(
        F.max_by(F.struct("name", "verdict"), F.when(F.col("listed"), F.struct(
            F.col("size"), F.col("verdict") == BLOCK, F.col("name")))).alias("_rule"),
        F.min(F.when(~F.col("listed") & (F.col("verdict") == BLOCK), F.col("name")))
        .alias("_pattern"))
    return (rows.join(decided, F.col("subject") == F.col("_subject"), "left").select(
        F.col("row_id").alias(row_id), "host", "path", F.col("_rule.name").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_pattern").isNotNull(), F.lit(BLOCK)),
                   F.lit(ALLOW)).alias("verdict"),
        F.col("_pattern").alias("pattern")))
