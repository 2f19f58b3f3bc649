"""URL filters: host-suffix / path-prefix expressions joined with a rule list by short digests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablefit.llm.common import ascii_lower, quoted

RULE_SCHEMA = "host string, path string, action string"
#: Hex digits of a digest that the join compares; the full digest is confirmed afterwards.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(expression: Column) -> Column:
    return F.sha2(expression, 256)


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]] | DataFrame) -> DataFrame:
    """Rules as (expression, digest, prefix, labels, path_chars, action), one for each expression.

    An expression is host + path.  Where a list both allows and blocks the same expression, block wins.
    Rules with a null or empty host, or an action other than allow and block, fit nothing.
    """
    df = rules if isinstance(rules, DataFrame) else spark.createDataFrame(list(rules), RULE_SCHEMA)
    host = ascii_lower(F.col("host"))
    path = F.coalesce(F.col("path"), F.lit(""))
    return (
        df.where("host is not null and host <> '' and action in ('allow', 'block')")
        .select(F.concat(host, path).alias("expression"), F.size(F.split(host, r"\.")).alias("labels"),
                F.length(path).alias("path_chars"), "action")
        .groupBy("expression", "labels", "path_chars").agg(F.max("action").alias("action"))
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
    )


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str, str]] | DataFrame, url_col: str = "url",
                 default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` (the winning expression, else null) and ``verdict``.

    A rule fits its host and all subdomains where the path starts with the rule's.  Of the rules that fit, the one with
    the longest host wins, then the one with the longest path.  No rule: ``default``.

    Distinct (host, path) pairs are expanded, so a URL that fills a third of the table is judged once.  Each pair
    gives one expression for each shape (host labels, path length) that the rules have: shapes, not rules, set
    the expansion.  Expressions meet rules by an equi-join on the first digits of their digests; a full digest confirms.
    Null urls have an empty host and path.  Input columns of the four result names give way to the results;
    repeated rows stay repeated; an empty table or rule list gives the default or no rows.
    """
    spark = pages.sparkSession
    judged = rule_table(spark, rules)
    # distinct shapes: host labels (at most 127 in a host name) by path lengths of the rule list
    shapes = [(r.labels, r.path_chars) for r in judged.select("labels", "path_chars").distinct().orderBy("labels", "path_chars").toLocalIterator()]
    rows = pages.withColumn("host", url_host(quoted(url_col))).withColumn("path", url_path(pages[_name(url_col)]))
    pairs = rows.select("host", "path").distinct()
    labels = F.size(F.split("host", r"\."))
    forms = [
        F.when((labels >= n) & (F.length("path") >= m),
               F.concat(F.substring_index("host", ".", -n), F.substring("path", 1, m)))
        for n, m in shapes
    ]
    found = (
        pairs.where("host <> ''")
        .select("host", "path", F.explode(F.array_compact(F.array(*forms)) if forms else F.array().cast("array<string>")).alias("expression"))
        .withColumn("digest", _digest(F.col("expression")))
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))
        .join(judged.select("prefix", F.col("digest").alias("full"), "labels", "path_chars", "action"), "prefix")
        .where("digest = full")
        .groupBy("host", "path")
        .agg(F.max(F.struct("labels", F.length("expression").alias("chars"), "expression", "action")).alias("best"))
        .select("host", "path", F.col("best.expression").alias("rule"), F.col("best.action").alias("verdict"))
    )
    kept = [quoted(c) for c in rows.columns if c not in ("rule", "verdict")]
    return (
        rows.select(*kept).join(found, ["host", "path"], "left")
        .select(*kept, "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))
    )


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
