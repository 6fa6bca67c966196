"""Review tables built from verdicts, scores and their sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.operators.gather import term_matches


def account_rollup(items: DataFrame, verdict_col: str = "is_flagged") -> DataFrame:
    """Per author: items, flagged items and share, worst score, last activity.

    ``items`` has author, the flag (null: not judged), max_score and created. For review
    queues only; the numbers say nothing about a person beyond the items listed.
    """
    flagged = F.count(F.when(F.col(verdict_col), 1))
    judged = F.count(verdict_col)
    return items.groupBy(F.col("author").alias("username")).agg(
        F.count(F.lit(1)).alias("posts"),
        judged.alias("judged_posts"),
        flagged.alias("flagged_posts"),
        F.when(judged > 0, flagged / judged).alias("flagged_share"),
        F.max("max_score").alias("max_score"),
        F.max("created").alias("last_updated"),
    )


def suggestion_rollup(verdicts: DataFrame, column: str = "suggested_prompt_modifications") -> DataFrame:
    """Distinct non-empty suggestions with their number."""
    text = F.trim(F.col(column))
    return verdicts.filter(text != "").groupBy(text.alias(column)).agg(F.count(F.lit(1)).alias("n"))


def glossary_matches(items: DataFrame, text: Column, terms: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Per item the number of distinct glossary terms it holds, and whether it holds several."""
    found = term_matches(items, text, terms, keys)
    return (
        found.groupBy(*keys)
        .agg(F.count_distinct("term").alias("n_terms"), F.sort_array(F.collect_set("term")).alias("terms"))
        .withColumn("several_terms", F.col("n_terms") >= 2)
    )


def verdicts_with_source(verdicts: DataFrame, comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Verdicts beside the comment and post they are about; null where the source is unknown."""
    comment_side = comments.select(
        F.col("id").alias("comment_id"), F.col("author").alias("comment_author"), F.col("body").alias("comment_body")
    )
    post_side = posts.select(
        F.col("id").alias("post_id"), F.col("title").alias("post_title"), F.col("author").alias("post_author")
    )
    return verdicts.join(comment_side, "comment_id", "left").join(post_side, "post_id", "left")
