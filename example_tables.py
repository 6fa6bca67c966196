"""Views of the driver's tables as forum tables, and a stand-in for the remote models.

The same views are written in SQL in ``oracle_tables.py``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwarden.operators.assess import ScorerError
from threadwarden.schemas import ATTRIBUTES

# One multiplier per attribute: a stand-in score that any engine can compute.
MULTIPLIERS = (7, 11, 13, 17, 19, 23, 29, 31, 37)
TERMS = ("the of", "und die", "que", "that with this", "les des", "el la", "nothing matches this", "Is It", "the-of", "***", "the\u00a0and")
NOW = 1_700_000_000.0 + 86_400 * 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def thread_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turn 0 of a conversation as a post."""
    return (
        table(spark, sf_dir, "conversations")
        .filter("turn = 0")
        .select(
            F.concat_ws("_", "conv_id", "turn").alias("id"),
            F.lit(None).cast("string").alias("title"),
            F.col("text").alias("selftext"),
            F.col("role").alias("author"),
            F.col("turn").alias("ord"),
        )
    )


def thread_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later turns as comments in a binary tree."""
    return (
        table(spark, sf_dir, "conversations")
        .filter("turn > 0")
        .select(
            F.concat_ws("_", "conv_id", "turn").alias("id"),
            F.expr("concat(if((turn - 1) div 2 = 0, 't3_', 't1_'), conv_id, '_', (turn - 1) div 2)").alias("parent_id"),
            F.col("text").alias("body"),
            F.col("role").alias("author"),
            F.col("turn").alias("ord"),
        )
    )


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event 0 as the only post: every other event is somewhere below it."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_id = 0")
        .select(
            F.col("event_id").cast("string").alias("id"),
            F.col("event_type").alias("title"),
            F.col("props").alias("selftext"),
            F.col("user_id").cast("string").alias("author"),
            F.col("event_id").alias("ord"),
        )
    )


def event_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All other events as one thread: event e answers event e div 2."""
    return (
        table(spark, sf_dir, "events")
        .filter("event_id > 0")
        .select(
            F.col("event_id").cast("string").alias("id"),
            F.expr("concat(if(event_id div 2 = 0, 't3_', 't1_'), event_id div 2)").alias("parent_id"),
            F.concat_ws(" ", "event_type", "props").alias("body"),
            F.col("user_id").cast("string").alias("author"),
            F.col("event_id").alias("ord"),
        )
    )


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("subreddit"),
        F.concat_ws(" ", "lang", "source").alias("title"),
        F.col("text").alias("selftext"),
        F.col("lang").alias("author"),
        F.col("n_chars").cast("double").alias("score"),
        (F.lit(1_700_000_000.0) + F.col("doc_id") * 60).alias("created"),
        F.lit("").alias("query"),
    )


def event_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as the items authors wrote."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("user_id").cast("string").alias("author"),
        F.col("event_type").alias("subreddit"),
        F.col("props").alias("body"),
        F.col("value").alias("score"),
        F.expr("timestampdiff(second, timestamp_ntz'1970-01-01', ts)").cast("double").alias("created"),
    )


def terms_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(enumerate(TERMS)), "term_no int, term string")


def stand_in_score(text: Column, multiplier: int) -> Column:
    return F.pmod(F.length(text) * multiplier, F.lit(1000)).cast("double") / F.lit(1000.0)


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in scores of every document in the scores table's columns."""
    text = F.col("text")
    length = F.length(text)
    parts = [
        c
        for a, m in zip(ATTRIBUTES, MULTIPLIERS)
        for c in (
            stand_in_score(text, m).alias(f"{a}_score"),
            F.pmod(length * m, F.lit(50)).cast("double").alias(f"{a}_max_span_begin"),
            (F.pmod(length * m, F.lit(50)) + m).cast("double").alias(f"{a}_max_span_end"),
        )
    ]
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), *parts)


def document_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("post_id"), F.col("text").alias("full_conversation")
    )


def stand_in_toxicity():
    """A classifier whose answers and failures follow from the text length alone."""
    tried = set()

    def score(text: str) -> str | None:
        n = len(text)
        kind = n % 10
        if kind == 1:
            raise ScorerError(429, "slow down")
        if kind == 3 and text not in tried:
            # until its retry only: the set must not grow with the calls
            tried.add(text)
            raise ScorerError(429, "slow down")
        tried.discard(text)
        if kind == 7:
            raise ScorerError(400, "bad request")
        if kind == 9:
            return None
        if kind == 5:
            return "{bad" if n % 20 == 5 else "{}"
        scores = {}
        for i, (name, m) in enumerate(zip(ATTRIBUTES, MULTIPLIERS)):
            value = (n * m) % 1000 / 1000.0
            spans = [
                {"begin": 0, "end": n // 2, "score": {"value": value, "type": "PROBABILITY"}},
                {"begin": n // 2, "end": n, "score": {"value": (n * m) % 7 / 10.0, "type": "PROBABILITY"}},
            ]
            scores[name.upper()] = {
                "summaryScore": {"value": value, "type": "PROBABILITY"},
                "spanScores": [] if (n + i) % 4 == 0 else spans,
            }
        if n % 3 == 0:
            del scores["THREAT"]
        return json.dumps({
            "languages": ["en"] if n % 2 == 0 else ["fr", "de"],
            "detectedLanguages": ["en"],
            "attributeScores": scores,
        })

    return score


def stand_in_judge():
    """A language model whose verdicts follow from the prompt's length and post id.

    The first verdict names the post's own comment, later ones name any.
    """

    def judge(prompt: str) -> str | None:
        n = len(prompt)
        post_id = prompt.removeprefix("[Post ID: ").partition("]")[0]
        if n % 7 == 0:
            return "[]"
        if n % 7 == 1:
            return '{"comment_id": "alone"}'
        if n % 7 == 2:
            return "[broken"
        odd = [5] if n % 14 == 6 else []
        return json.dumps([
            {
                "user_id": f"u{n % 5}" if i else "[deleted]",
                "post_id": "made up",
                "comment_id": f"c{n % 11 + i}" if i else f"c{post_id}",
                "is_flagged": (n + i) % 3 == 0,
                "reasoning": f"length {n}",
                "suggested_prompt_modifications": "" if i else f"hint {n % 4}",
            }
            for i in range(n % 7 - 2)
        ] + odd)

    return judge
