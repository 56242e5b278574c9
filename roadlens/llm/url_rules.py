"""URL rules looked up by their rarest word; only rules fetched this way run their pattern."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = "[0-9a-z\\x{80}-\\x{10FFFF}]+"


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is matched against ``host + path``; ``words`` are texts that every match has whole.

    ``rank`` decides between rules that fit: the largest, then the smallest name.
    """

    name: str
    verdict: str
    pattern: str
    words: tuple[str, ...]
    rank: int


def host_path_rule(verdict: str, host: str, path: str) -> UrlRule:
    """A host, its subdomains, and every path that starts with ``path``; the longest rule ranks first."""
    whole = path if path.endswith(("/", "-", "_", ".")) else path.rpartition("/")[0] + "/"
    words = tuple(re.findall("[0-9a-z]+", f"{host}{whole}".lower()))
    # in a path the case of a letter counts: words are looked up in lower case, the pattern decides
    pattern = "^(?:[^/]*\\.)?" + _literal(host) + _literal(path)
    return UrlRule(host + path, verdict, pattern, words, 1000 + len(host) + len(path))


def host_word_rule(verdict: str, word: str) -> UrlRule:
    """Hosts one of whose labels is ``word``."""
    words = tuple(re.findall("[0-9a-z]+", word))
    return UrlRule(f"||{word}", verdict, "^(?:[^/]*\\.)?" + _literal(word) + "(?:\\.[^/]*)?(?:/|$)", words, len(word))


def _literal(text: str) -> str:
    return "".join(c if c.isalnum() or c == "/" else f"\\{c}" for c in text)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _rules(spark: SparkSession, rules: list[UrlRule]) -> DataFrame:
    schema = "name string, verdict string, pattern string, words array<string>, rank int"
    return spark.createDataFrame(
        [(r.name, r.verdict, r.pattern, list(dict.fromkeys(r.words)), r.rank) for r in rules], schema
    )


def judge_urls(
    pages: DataFrame, rules: list[UrlRule], id_col: str = "page_id", url_col: str = "url", default: str = "allow"
) -> DataFrame:
    """``(id_col, host, path, rule, verdict)``, a row for every row of ``pages``.

    Words are runs of a-z, 0-9 and characters beyond ASCII in the lower-cased host and path. How
    many URLs have each word of a rule is counted over all pages; a rule is filed under its
    rarest word. A URL fetches the rules filed under its words, and those alone are tried. Of
    the rules that fit, the one of highest rank gives ``rule`` and ``verdict``; where none
    does, ``rule`` is null and ``verdict`` is ``default``. A rule without words is tried everywhere.

    Each URL's rows are combined before they are shuffled, and its row number, not its host or
    words, is the key, so common hosts and words make no large group. The rules, a list that the
    caller holds, are sent to every task.

    A null URL, or one without ``://``, has an empty host and path. Repeated rows and ids are
    judged each by itself; other columns are ignored, and no rows give no rows.
    """
    spark = pages.sparkSession
    urls = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(url_host(F.col(url_col)), F.lit("")).alias("host"),
        F.coalesce(url_path(F.col(url_col)), F.lit("")).alias("path"),
    )
    target = F.concat("host", "path")
    words = F.array_distinct(F.regexp_extract_all(F.lower(target), F.lit(f"({WORD})"), 1))
    known = _rules(spark, rules)
    rule_words = known.select("name", "pattern", F.explode("words").alias("word"))
    counts = (
        urls.select(F.explode(words).alias("word"))
        .join(F.broadcast(rule_words.select("word").distinct()), "word", "left_semi")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )
    rarest = (
        rule_words.join(counts, "word", "left")
        .groupBy("name", "pattern")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word")).alias("at"))
        .select("name", "pattern", F.col("at.word").alias("word"))
    )
    filed = known.drop("words").join(rarest, ["name", "pattern"], "left")
    filed = filed.select(F.coalesce("word", F.lit("")).alias("word"), "name", "verdict", "pattern", "rank")

    asked = urls.withColumn("row", F.monotonically_increasing_id()).withColumn("target", target)
    asked = asked.withColumn("word", F.explode(F.concat(F.array(F.lit("")), words)))
    tried = asked.join(F.broadcast(filed), "word", "left")
    fits = F.expr("target rlike pattern")
    # the smallest of (-rank, name): the highest rank, then the first name
    best = F.min(F.when(fits, F.struct((-F.col("rank")).alias("order"), "name", "verdict")))
    out = tried.groupBy("row", "id", "host", "path").agg(best.alias("best"))
    return out.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("best.name").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
    )
