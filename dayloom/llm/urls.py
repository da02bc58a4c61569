"""URL filters: host-suffix and path-prefix expressions against hashed rules."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
PREFIX_DIGITS = 8  # hexadecimal digits of the digest that the join compares


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    """Rules as rows of ``host``, ``path`` (empty or from its slash on) and ``verdict``."""
    return spark.createDataFrame(rules, "host string, path string, verdict string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row.

    A rule holds for its host and all subdomains where the path starts with the rule's. The longest rule
    (host and path together) wins, then the longer host, then ``block``. A url that no rule fits, that is
    null or has no ``://`` gets ``default``. Only suffixes of as many labels and prefixes of as many characters as
    some rule has are made, so a long url makes no more expressions than a short one. Each distinct url is
    judged once; repeated rows keep their number. A rule with a null host or path fits nothing.

    The rule table is joined by the first digits of the digest; Spark broadcasts it only while it is
    below its own size limit and otherwise joins by sorting, splitting hot digests.
    """
    rules = rules.select(
        F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).where("r_host IS NOT NULL AND r_path IS NOT NULL")
    rules = rules.withColumn("rule", F.concat("r_host", "r_path")).withColumn("r_digest", F.sha2("rule", 256))
    shapes = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("r_host", r"\.")))), F.sort_array(F.collect_set(F.length("r_path")))
    ).first()
    keyed = pages.select("page_id", "url")
    host, path = host_and_path(F.col("url"))
    parts = keyed.select("url").where("url IS NOT NULL").distinct().select("url", host.alias("host"), path.alias("path"))
    labels = F.split("host", r"\.")
    expressions = [
        F.when(
            (F.size(labels) >= n) & (F.length("path") >= k) & (F.col("host") != ""),
            F.concat(
                F.array_join(F.slice(labels, F.size(labels) - (n - 1), F.lit(n)), "."), F.substring(F.col("path"), 1, k)
            ),
        )
        for n in shapes[0]
        for k in shapes[1]
    ]
    found = F.array_compact(F.array(*expressions)) if expressions else F.array().cast("array<string>")
    candidates = parts.select("url", F.explode(found).alias("expression")).select(
        "url", F.sha2("expression", 256).alias("digest")
    )
    short = lambda column: F.substring(column, 1, PREFIX_DIGITS)
    fits = (
        candidates.withColumn("short", short("digest"))
        .join(rules.withColumn("short", short("r_digest")), "short")
        .where(F.col("digest") == F.col("r_digest"))
    )
    order = F.struct(
        F.length("rule").alias("n"), F.length("r_host").alias("h"), (F.col("r_verdict") == "block").alias("b"), "rule", "r_verdict"
    )
    best = fits.groupBy("url").agg(F.max(order).alias("best")).select("url", "best.rule", F.col("best.r_verdict").alias("said"))
    return keyed.join(best, "url", "left").select(
        "page_id", host.alias("host"), path.alias("path"), "rule", F.coalesce("said", F.lit(default)).alias("verdict")
    )
