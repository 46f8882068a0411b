"""Operator 10: url filtering with rules indexed by their rarest token.

A rule is a host pattern and a path start, or a regular expression over
``host/path`` with its literal tokens. The tokens of all urls are counted;
each rule is filed under the one of its literal tokens that is rarest in
them. A url's tokens then fetch the rules filed under them by an
equi-join, and only those run their regular expressions. The longest rule
that fits decides; equal lengths fall to the first by code point.

Base rules (host, path) come first; where none fits, the filter's own
patterns (``PATTERNS``) give the verdict, and allow is the default.

Only SQL functions are used. Distinct urls are judged once and joined back
to the rows on their whole host and path.

Defined results: null urls and urls without ``://`` have empty host and
path, no rule and verdict allow; repeated rows are kept; extra columns are
ignored; an empty table gives an empty table. A rule without a literal
token is filed under a token that every url has.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values: (verdict, host, path) of the base rules.
BASE_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Own patterns over host + path: (verdict, regular expression, literal tokens).
PATTERNS = (
    ("block", r"(^|[.-])cheap-(pills|meds|viagra)([.-]|$|/)", ("cheap",)),
    ("block", r"(^|[.-])(online-)?casino([.-]|$|/)", ("casino",)),
    ("block", r"(^|[.-])adult-(chat|video|content)([.-]|$|/)", ("adult",)),
    ("block", r"(^|[.-])free-(money|porn|spins)([.-]|$|/)", ("free",)),
    ("block", r"/wp-login\.php$", ("wp", "login", "php")),
)
_EVERY = ""


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _tokens(where: Column) -> Column:
    return F.array_distinct(F.split(where, "[^A-Za-z0-9]+"))


def _rule_rows(base, patterns) -> list[tuple]:
    out = []
    for verdict, name, start in base:
        literal = set(re.findall("[A-Za-z0-9]+", name))
        literal |= set(re.findall("/([A-Za-z0-9]+)(?=[^A-Za-z0-9])", start))  # whole path tokens only
        out.append((name + start, True, verdict, rf"(?s)^([^/]*\.)?{re.escape(name)}{re.escape(start)}", sorted(literal) or [_EVERY]))
    out += [(p, False, verdict, p, list(tokens) or [_EVERY]) for verdict, p, tokens in patterns]
    return out


def rule_table(spark: SparkSession, base=BASE_RULES, patterns=PATTERNS) -> DataFrame:
    rows = [F.struct(*[F.lit(x).alias(n) for n, x in zip(("rule", "base", "verdict", "pattern", "tokens"), r)])
            for r in _rule_rows(base, patterns)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict per row."""
    rules = rule_table(pages.sparkSession) if rules is None else rules
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"))
    where = F.concat("host", "path")
    urls = rows.where("host <> ''").select(where.alias("at")).distinct()
    asked = urls.select("at", F.explode(F.array_union(_tokens(F.col("at")), F.array(F.lit(_EVERY)))).alias("token"))
    literal = rules.select("rule", F.explode("tokens").alias("token"))
    seen = asked.join(literal.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("n"))
    filed = (literal.join(seen, "token", "left").groupBy("rule")
             .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("rarest"))
             .select("rule", "rarest.token"))
    index = rules.drop("tokens").join(filed, "rule")
    fits = asked.join(index, "token").where(F.regexp_like("at", F.col("pattern")))
    # longest first, then by code point: the least (-length, rule)
    best = lambda own: F.min(F.when(F.col("base") == own, F.struct(-F.length("rule"), "rule", "verdict")))
    judged = fits.groupBy("at").agg(best(True).alias("b"), best(False).alias("m"))
    out = rows.join(judged, where == F.col("at"), "left")
    return out.select("page_id", "host", "path", F.col("b.rule").alias("rule"),
                      F.coalesce("b.verdict", "m.verdict", F.lit("allow")).alias("verdict"))
