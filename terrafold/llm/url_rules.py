"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a path pattern (``*`` any run of characters) and, optionally, a host
that it holds for with all subdomains. Every rule is a regular expression over
``host + path``; to run only few of them, each rule is filed under one of its
literal tokens, the one that the fewest distinct URLs contain. A URL's own
tokens fetch the rules to try. A token of a rule counts as literal only if the
pattern itself ends it on both sides, so the URL must hold it as a token too;
rules without such a token are tried on every URL, apart from the index."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rules without a literal token that are tried in one pass over the URLs.
TOGETHER = 200
SPLIT = re.compile(r"[^A-Za-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``host``: the host and its subdomains ('' for any); ``path``: pattern from the path's start
    ('*' any characters), open at the end. ``exact`` rules beat all others; the longest wins."""

    verdict: str
    host: str
    path: str
    exact: bool = True

    @property
    def name(self) -> str:
        return f"{self.host}{self.path}"

    @property
    def regex(self) -> str:
        path = ".*".join(re.escape(x) for x in self.path.split("*"))
        return f"(?s)^(?:[^/]*\\.)?{re.escape(self.host)}{path}" if self.host else f"(?s)^[^/]*{path}"

    @property
    def tokens(self) -> list[str]:
        """Literal tokens that the pattern bounds on both sides."""
        host = [t for t in SPLIT.split(self.host) if t]
        text = self.path
        out = [m[0] for m in re.finditer(r"[A-Za-z0-9]+", text)
               if (m.start() == 0 or text[m.start() - 1] != "*") and m.end() < len(text) and text[m.end()] != "*"]
        return sorted({*host, *out})


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://`` or for null."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; '' without ``://`` or for null."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


RULES = "name string, regex string, verdict string, exact boolean, length int, tokens array<string>"


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    """Rules as a table that :func:`judge` takes; a large list is better kept as one than built each time."""
    return spark.createDataFrame([(r.name, r.regex, r.verdict, r.exact, len(r.name), r.tokens) for r in rules], RULES)


def judge(pages: DataFrame, rules: list[Rule] | DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url; others ignored) -> one row per page row: page_id, host, path, rule,
    verdict, matched. ``rules``: a list, or a table as :func:`rule_table` builds it, of any size.

    rule: name of the longest exact rule that fits, else null; verdict: that rule's, else that of
    the longest other rule that fits (matched names it), else ``default``. Ties in length go to the
    smaller name, then to the smaller verdict. Null URLs and those without ``://`` have empty host and path. Null page_ids and
    repeated rows are judged like any row; distinct URLs are judged once, so a URL that a third of the rows
    share costs one. Empty tables give no rows; an empty rule list gives the default everywhere."""
    spark = pages.sparkSession
    src = pages.select("page_id", host_of(F.col("url").cast("string")).alias("host"), path_of(F.col("url").cast("string")).alias("path"))
    listed = rules if isinstance(rules, DataFrame) else rule_table(spark, rules)
    urls = src.select("host", "path").distinct()
    tokens = F.array_distinct(F.filter(F.split(F.concat("host", F.lit("/"), "path"), "[^A-Za-z0-9]+"), lambda t: t != ""))
    by_token = urls.select("host", "path", F.explode(tokens).alias("token"))
    literal = listed.select("regex", F.explode("tokens").alias("token"))
    # how many distinct URLs hold each token that a rule could be filed under
    counts = by_token.join(literal.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (literal.join(counts, "token", "left").groupBy("regex")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token"))["token"].alias("token")))
    index = listed.join(rarest, "regex").drop("tokens")
    fields = ["name", "verdict", "exact", "length"]
    tried = by_token.join(index, "token").where(F.expr("rlike(concat(host, path), regex)")).select("host", "path", *fields)
    # the patterns of rules without a literal token are conditions of one pass over the URLs, some at a time
    free = listed.where(F.size("tokens") == 0).select("regex", *fields).distinct().collect()
    for i in range(0, len(free), TOGETHER):
        hits = F.array(*[F.when(F.concat("host", "path").rlike(r["regex"]), F.struct(*[F.lit(r[c]).alias(c) for c in fields])) for r in free[i : i + TOGETHER]])
        tried = tried.unionByName(urls.select("host", "path", F.explode(F.array_compact(hits)).alias("r")).select("host", "path", "r.*"))
    # exact first, then the longest, then the smaller name
    best = (tried.groupBy("host", "path")
            .agg(F.min(F.struct((~F.col("exact")).alias("o"), (-F.col("length")).alias("l"), "name", "verdict")).alias("b"))
            .select(F.col("host").alias("h"), F.col("path").alias("p"), F.col("b.o").alias("other"), F.col("b.name").alias("matched"), F.col("b.verdict").alias("ruled")))
    got = src.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return got.select("page_id", "host", "path", F.when(~F.col("other"), F.col("matched")).alias("rule"), F.coalesce("ruled", F.lit(default)).alias("verdict"), "matched")
