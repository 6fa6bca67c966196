"""Table schemas: fixed ones, ones read from schema files, ones generated from attributes."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import types as T

# JSON type names of schema files and the toxicity attributes, in order.
JSON_TYPES = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "integer": T.LongType(),
    "boolean": T.BooleanType(),
    "array": T.ArrayType(T.StringType()),
}
ATTRIBUTES = (
    "toxicity",
    "severe_toxicity",
    "identity_attack",
    "insult",
    "profanity",
    "threat",
    "attack_on_author",
    "attack_on_commenter",
    "inflammatory",
)
POSTS = (
    "subreddit string, selftext string, title string, downs double, upvote_ratio double, ups double, "
    "score double, created double, over_18 boolean, author_is_blocked boolean, id string, author string, "
    "url string, _comments_by_id array<string>, query string, perspective_id string, custom_llm_id string"
)
COMMENTS = (
    "author_is_blocked boolean, subreddit string, id string, author string, parent_id string, score double, "
    "body string, downs double, created double, controversiality double, ups double, query string, "
    "perspective_id string, custom_llm_id string"
)
CONFIG = (
    "subreddits array<string>, search_terms array<string>, requestedAttributes map<string,struct<scoreType:string>>"
)
# One classifier response: languages, and per attribute a summary score and scored spans.
TOXICITY_RESPONSE = (
    "languages array<string>, detectedLanguages array<string>, "
    "attributeScores map<string,struct<summaryScore:struct<value:double,type:string>,"
    "spanScores:array<struct<begin:int,end:int,score:struct<value:double,type:string>>>>>, "
    "_corrupt_record string"
)
# What a scorer call returns per item, before any parsing.
SCORER_OUTPUT = (
    "response_json string, attempts int, errors array<struct<at:timestamp,error_code:int,message:string,details:string>>"
)


def table_schema(schema_json: str) -> T.StructType:
    """Table columns of a schema file: its ``properties``, in order."""
    properties = json.loads(schema_json)["properties"]
    return T.StructType([T.StructField(name.lower(), JSON_TYPES[p["type"]]) for name, p in properties.items()])


def response_ddl(schema_json: str) -> str:
    """DDL of the items of an array response schema, for parsing verdicts."""
    items = json.loads(schema_json)["items"]
    return T.StructType([T.StructField(n, JSON_TYPES[p["type"]]) for n, p in items["properties"].items()]).simpleString()


def score_columns(attributes: Sequence[str] = ATTRIBUTES) -> list[str]:
    return [f"{a.lower()}_{part}" for a in attributes for part in ("score", "max_span_begin", "max_span_end")]


def scores_schema(attributes: Sequence[str] = ATTRIBUTES) -> T.StructType:
    """Scores table for a list of attributes."""
    text = ("perspective_id", "sheet_name", "subreddit", "post_id", "languages", "detected_languages")
    return T.StructType(
        [T.StructField(c, T.StringType()) for c in text]
        + [T.StructField(c, T.DoubleType()) for c in score_columns(attributes)]
    )


def verdict_type(verdict_col: str = "is_flagged") -> T.StructType:
    """One verdict of the language model; the flag is named after the category screened."""
    return T.StructType.fromDDL(
        f"user_id string, post_id string, comment_id string, {verdict_col} boolean, "
        "reasoning string, suggested_prompt_modifications string"
    )


def verdicts_schema(verdict_col: str = "is_flagged") -> T.StructType:
    stamped = T.StructType.fromDDL("gemini_id string, sheet_name string, conversation_length bigint, tokens_used bigint")
    return T.StructType(verdict_type(verdict_col).fields + stamped.fields)
