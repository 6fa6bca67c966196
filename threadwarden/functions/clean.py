"""Record cleaning: nested fields to scalars, retained columns, null rules, parent ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns a cleaned record keeps, those it drops first, those it always
# has, the texts that stand in for missing values and the cell texts read as null.
RETAINED = (
    "subreddit",
    "selftext",
    "title",
    "query",
    "_comments_by_id",
    "author",
    "created",
    "id",
    "score",
    "upvote_ratio",
    "url",
    "author_is_blocked",
    "over_18",
    "parent_id",
    "body",
    "controversiality",
    "ups",
    "downs",
    "perspective_id",
    "custom_llm_id",
)
DROPPED = ("_replies", "_submission", "_reddit", "_comments", "selftext_html")
ALWAYS_PRESENT = ("query", "perspective_id", "custom_llm_id")
POST_FILL = {"title": "[No Title]", "selftext": "[No Content]", "author": "[Unknown Author]"}
COMMENT_FILL = {"body": "[No Content]", "author": "[Unknown Author]"}
NULL_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> DataFrame:
    """Fail before any job runs when columns are missing."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing columns in {what}: {missing}")
    return df


def lower_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def nulls_from_tokens(df: DataFrame, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn null-like cell texts of string columns into nulls."""
    return df.select(
        *[
            F.when(~F.col(f.name).isin(*tokens), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema
        ]
    )


def scalar_fields(df: DataFrame) -> DataFrame:
    """Nested forum fields as scalars: community and author names, comment ids, times."""
    types = {f.name: f.dataType for f in df.schema}
    changes: dict[str, Column] = {}
    if isinstance(types.get("subreddit"), T.StructType):
        changes["subreddit"] = F.col("subreddit.display_name")
    if isinstance(types.get("author"), T.StructType):
        changes["author"] = F.col("author.name")
    if isinstance(types.get("_comments_by_id"), T.MapType):
        changes["_comments_by_id"] = F.map_keys("_comments_by_id")
    if isinstance(types.get("created_utc"), T.NumericType):
        changes["created_utc"] = epoch_text(F.col("created_utc"))
    return df.withColumns(changes) if changes else df


def epoch_text(seconds: Column) -> Column:
    """Epoch seconds as ``YYYY-MM-DD HH:MM:SS`` in the session time zone."""
    return F.date_format(F.timestamp_seconds(seconds), "yyyy-MM-dd HH:mm:ss")


def retain(df: DataFrame) -> DataFrame:
    return df.select(*[c for c in RETAINED if c in df.columns])


def with_defaults(df: DataFrame, names: Sequence[str] = ALWAYS_PRESENT) -> DataFrame:
    absent = [n for n in names if n not in df.columns]
    return df.withColumns({n: F.lit("") for n in absent}) if absent else df


def clean_records(df: DataFrame) -> DataFrame:
    """Raw forum records as table rows."""
    return with_defaults(retain(scalar_fields(df.drop(*DROPPED))))


def fill_posts(df: DataFrame) -> DataFrame:
    return df.na.fill(POST_FILL)


def fill_comments(df: DataFrame) -> DataFrame:
    return df.na.fill(COMMENT_FILL)


# Prefixes that tell what kind of thing a parent id names.
POST_PREFIX = "t3_"
COMMENT_PREFIX = "t1_"


def parent_kind(parent_id: Column) -> Column:
    return F.when(parent_id.startswith(POST_PREFIX), "post").when(parent_id.startswith(COMMENT_PREFIX), "comment")


def parent_key(parent_id: Column) -> Column:
    """The id after the kind prefix; null when there is no known prefix."""
    return F.when(parent_kind(parent_id).isNotNull(), F.right(parent_id, F.length(parent_id) - 3))


def member_ignoring_case(column: Column, values: Sequence[str]) -> Column:
    return F.lower(column).isin(*[v.lower() for v in values])


def recent(created: Column, days_back: float | None, now: float) -> Column:
    """Whether an epoch time lies at most ``days_back`` days before ``now``; None keeps all."""
    if days_back is None:
        return F.lit(True)
    return created >= F.lit(now - days_back * 86400.0)
