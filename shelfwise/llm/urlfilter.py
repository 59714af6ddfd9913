"""URL rules by hash prefix: expand, join on short prefixes, confirm full digests, let the longest win.

Each URL is expanded into expressions, a host suffix followed by a path prefix.  Expressions and rules
are equi-joined on the first ``PREFIX_BYTES`` bytes of their SHA-256 and confirmed by the full digest;
of a URL's rules the longest expression wins (then the longer host, then the smaller text).

Only suffixes with as many labels, and prefixes as long, as some rule has are expanded: both numbers
are gathered from the rules and are bounded by the longest host and path of a rule, not by its rows.
Equal (id, url) rows are judged once, so a URL on a third of all rows meets in one partial aggregate;
how the rules are joined (broadcast or shuffled, with skewed partitions split) is left to Spark, which
knows their size.  All of it is DataFrame functions.

Defined results: a null URL, or one without ``://``, has an empty host and path and gets the default
verdict; repeated rows come back as often as they came; an empty table gives no rows; rules that are
null in any column are ignored; of rules that state one expression twice, block beats allow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import ascii_lower

#: Bytes of a digest that the join compares.
PREFIX_BYTES = 4
DEFAULT_VERDICT = "allow"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://``, and the path up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _digest(expression: Column) -> Column:
    return F.sha2(expression.cast("binary"), 256)


def judge(urls: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """(id, url, host, path, rule, verdict) of each row; ``rules`` has host, path and verdict."""
    rules = (rules.select(ascii_lower(F.col("host")).alias("host"), "path", "verdict").na.drop()
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
             .select(F.concat("host", "path").alias("rule"), "verdict", F.length("host").alias("host_len"),
                     F.length("path").alias("path_len"), F.size(F.split("host", r"\.")).alias("labels")))
    # Bounded by the labels of one host and the length of one path.
    sizes = rules.agg(F.collect_set("labels").alias("labels"), F.collect_set("path_len").alias("paths")).first()
    table = rules.select("rule", "verdict", "host_len", _digest(F.col("rule")).alias("rule_digest"))
    table = table.withColumn("short", F.substring("rule_digest", 1, 2 * PREFIX_BYTES))

    host, path = host_and_path(F.col(url_col))
    pages = (urls.select(F.col(id_col), F.col(url_col)).groupBy(id_col, url_col).agg(F.count("*").alias("copies"))
             .withColumns({"host": host, "path": path}))
    suffixes = F.array(*[F.when(F.size(F.split("host", r"\.")) >= n, F.substring_index("host", ".", -n))
                         for n in sorted(sizes["labels"])]).cast("array<string>")
    prefixes = F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n))
                         for n in sorted(sizes["paths"])]).cast("array<string>")
    pages = pages.withColumn("expressions", F.flatten(F.transform(
        F.array_compact(suffixes), lambda h: F.transform(F.array_compact(prefixes), lambda p: F.concat(h, p)))))
    expanded = (pages.withColumn("expression", F.explode_outer("expressions")).drop("expressions")
                .withColumn("digest", _digest(F.col("expression")))
                .withColumn("short", F.substring("digest", 1, 2 * PREFIX_BYTES)))
    found = expanded.join(table, "short", "left").withColumn(
        "hit", F.when(F.col("digest") == F.col("rule_digest"),
                      F.struct(F.length("rule").alias("len"), "host_len", "rule", "verdict")))
    best = found.groupBy(id_col, url_col).agg(
        F.first("copies").alias("copies"), F.first("host").alias("host"), F.first("path").alias("path"),
        F.max("hit").alias("hit"))
    return best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(
        id_col, url_col, "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", F.lit(default)).alias("verdict"))
