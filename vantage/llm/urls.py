"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over ``host + path`` plus the literal tokens
that any address it fits must hold (whole host labels and whole path segments).
Each rule is entered in the index under its rarest token, as counted over the
addresses at hand (rules without a literal token are entered under the empty
token, which every address has).  An address looks up its own tokens, and only the
rules fetched that way run their regular expression.  The longest rule that fits
wins, on equal length an allow rule; without one the verdict is ``default``.

Equal addresses are judged once, so a hot address costs one row; a hot token is
joined to its few rules by a join whose small side Spark sizes itself.

Cases: null urls and urls without ``://`` have empty host and path and fit only
rules without a host; rows with equal or null ids are judged one by one; very long
urls are matched whole; an empty table gives an empty result; other columns are
ignored; rules that repeat count once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: the rules of the registered query (verdict, host, start of the path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path_rule(verdict: str, host: str, path: str) -> tuple[str, str, str, int, list[str]]:
    """(name, verdict, pattern, length, literal tokens) of a host and path rule: it fits
    the host and its subdomains, if the path starts with ``path``."""
    # a label or segment is literal only if both its ends are fixed
    tokens = [f"h:{x}" for x in host.split(".") if x] + [f"p:{x}" for x in path.split("/")[1:-1] if x]
    quote = lambda s: re.sub(r"([^0-9A-Za-z/_-])", r"\\\1", s)
    return host + path, verdict, rf"^(?:[^/]*\.)?{quote(host)}{quote(path)}", len(host + path), tokens


def host(url: Column) -> Column:
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(raw, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_filter(df: DataFrame, rules: Iterable[tuple[str, str, str, int, list[str]]], id_col: str = "page_id",
               url_col: str = "url", default: str = "allow") -> DataFrame:
    """Per row: id, host, path, rule (null: none fits), verdict."""
    spark = df.sparkSession
    src = df.select(F.col(id_col).alias("id"), host(F.col(url_col).cast("string")).alias("host"),
                    path(F.col(url_col).cast("string")).alias("path"))
    sites = src.select("host", "path").distinct()
    tokens = F.array_distinct(F.concat(
        F.array(F.lit("")),
        F.transform(F.filter(F.split("host", r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.filter(F.split("path", "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x))))
    looked = sites.select("host", "path", F.explode(tokens).alias("token"))

    listed = spark.createDataFrame(
        sorted({(n, v, p, k, tuple(t)) for n, v, p, k, t in rules}),
        "rule string, verdict string, pattern string, size int, tokens array<string>")
    literal = listed.select("rule", F.explode("tokens").alias("token"))
    seen = looked.join(literal.select("token").distinct(), "token").groupBy("token").agg(F.count("*").alias("seen"))
    rarest = (literal.join(seen, "token", "left")
              .groupBy("rule").agg(F.min(F.struct(F.coalesce("seen", F.lit(0)), "token")).alias("key")))
    index = (listed.join(rarest, "rule", "left")
             .select("rule", "verdict", "pattern", "size", F.coalesce("key.token", F.lit("")).alias("token")))

    fits = looked.join(index, "token").where(F.expr("concat(host, path) rlike pattern"))
    best = (fits.groupBy("host", "path")
            .agg(F.max(F.struct("size", (F.col("verdict") == "allow").alias("allow"), "rule", "verdict")).alias("won"))
            .select("host", "path", "won.rule", "won.verdict"))
    return (src.join(best, ["host", "path"], "left")
            .select(F.col("id").alias(id_col), "host", "path", "rule",
                    F.coalesce("verdict", F.lit(default)).alias("verdict")))
