"""URL rules matched by hashed host-suffix and path-prefix expressions.

Every URL is expanded into the (host suffix, path prefix) expressions that a rule could
name. Expressions meet rules in an equi-join on the first four bytes of their digests; full
digests confirm, and the longest rule wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHORT_HEX = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    found = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(F.coalesce(found, F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """From the end of the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def prepare_rules(rules: DataFrame) -> DataFrame:
    """(host, path, verdict) rules with digests; of one host and path, block outranks allow."""
    return (
        rules.select(
            F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("rule_host"),
            F.coalesce("path", F.lit("")).alias("rule_path"),
            "verdict",
        )
        .filter("rule_host <> ''")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("rule_verdict"))
        .withColumn("digest", _digest(F.col("rule_host"), F.col("rule_path")))
        .withColumn("short", F.substring("digest", 1, SHORT_HEX))
    )


def expressions(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Digests of the URL's expressions of the given shapes: labels of host, length of path.

    Only shapes that some rule has are made, so a host of very many labels or a very long
    path costs no more than the rules ask for.
    """
    labels = F.split(host, r"\.", -1)
    wanted = F.array(*[F.struct(F.lit(n).alias("labels"), F.lit(m).alias("chars")) for n, m in shapes])
    usable = F.filter(wanted, lambda s: (s["labels"] <= F.size(labels)) & (s["chars"] <= F.length(path)))
    return F.transform(
        usable,
        lambda s: _digest(
            F.array_join(F.slice(labels, F.size(labels) - s["labels"] + 1, s["labels"]), "."),
            F.substring(path, F.lit(1), s["chars"]),
        ),
    )


def judge_urls(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """Every distinct url of ``urls`` with its host, path, rule and verdict.

    A rule fits its host and all subdomains if the url's path starts with the rule's. The
    longest host and path together wins; of equally long ones the longer host. ``rule`` is
    null and the verdict ``default`` where none fits, also for a null url or one without
    ://, whose host and path are empty. Without rules every url gets the default. The number
    of rule shapes comes to the driver, not the rules; Spark broadcasts the rules only where
    their size allows, and splits expressions that very many urls share if they are shuffled.
    """
    parsed = urls.select("url").distinct().select("url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    prepared = prepare_rules(rules)
    shapes = prepared.select(F.size(F.split("rule_host", r"\.", -1)).alias("n"), F.length("rule_path").alias("m")).distinct()
    shapes = sorted((r["n"], r["m"]) for r in shapes.collect())
    if not shapes:
        return parsed.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    expanded = parsed.select("url", F.explode(expressions(F.col("host"), F.col("path"), shapes)).alias("of_url"))
    expanded = expanded.withColumn("short", F.substring("of_url", 1, SHORT_HEX))
    confirmed = expanded.join(prepared, "short").filter("of_url = digest")
    chars = F.length("rule_host") + F.length("rule_path")
    best = confirmed.groupBy("url").agg(
        F.max_by(
            F.struct(F.concat("rule_host", "rule_path").alias("rule"), "rule_verdict"), F.struct(chars, F.length("rule_host"))
        ).alias("best")
    )
    judged = parsed.join(best.withColumnRenamed("url", "_url"), F.col("url") == F.col("_url"), "left")
    return judged.select(
        "url", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")
    )


def judge_pages(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id of every row of ``pages``, repeated rows too, with what :func:`judge_urls` says."""
    judged = judge_urls(pages, rules, default).withColumnRenamed("url", "_url")
    found = pages.select("page_id", "url").join(judged, F.col("url") == F.col("_url"), "left")
    # null urls join nothing
    return found.select(
        "page_id",
        F.coalesce("host", F.lit("")).alias("host"),
        F.coalesce("path", F.lit("")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
