import pytest
from pyspark.sql import functions as F

from threadwarden import schemas
from threadwarden.functions import clean, text


def test_clean_records(spark):
    raw = spark.createDataFrame(
        [(("forum",), ("ann",), {"c1": "x", "c2": "y"}, 86400.0, 86400.0, "p1", "<p>", 7), (("forum",), None, None, None, None, "p2", None, 8)],
        "subreddit struct<display_name:string>, author struct<name:string>, _comments_by_id map<string,string>, "
        "created_utc double, created double, id string, selftext_html string, extra int",
    )
    assert clean.scalar_fields(raw).first().created_utc == "1970-01-02 00:00:00"
    cleaned = clean.clean_records(raw)
    assert cleaned.columns == ["subreddit", "_comments_by_id", "author", "created", "id", "query", "perspective_id", "custom_llm_id"]
    first, second = cleaned.orderBy("id").collect()
    assert (first.subreddit, first.author, sorted(first._comments_by_id), first.query) == ("forum", "ann", ["c1", "c2"], "")
    assert (second.author, second._comments_by_id) == (None, None)


def test_null_tokens_then_fill(spark):
    cells = ["kept", "", "NA", "N/A", "null", "None", "nan", "#N/A", "<NA>", None, "na", " NA"]
    posts = spark.createDataFrame([(str(i), c, c, c) for i, c in enumerate(cells)], "id string, title string, selftext string, author string")
    filled = clean.fill_posts(clean.nulls_from_tokens(posts)).collect()
    shown = {r.title for r in filled}
    assert shown == {"kept", "[No Title]", "na", " NA"}
    assert {r.author for r in filled if r.title == "[No Title]"} == {"[Unknown Author]"}


def test_parent_decode(spark):
    df = spark.createDataFrame([("t3_abc",), ("t1_x",), ("t1_",), ("zz_x",), (None,)], "parent_id string")
    got = df.select(clean.parent_kind(F.col("parent_id")), clean.parent_key(F.col("parent_id"))).collect()
    assert [tuple(r) for r in got] == [("post", "abc"), ("comment", "x"), ("comment", ""), (None, None), (None, None)]


def test_required_columns_fail_before_any_job(spark):
    with pytest.raises(ValueError, match=r"posts: \['title'\]"):
        clean.require_columns(spark.range(1), ["id", "title"], "posts")


def test_recency_is_inclusive(spark):
    df = spark.createDataFrame([(0.0,), (99.0,), (100.0,), (None,)], "created double")
    now = 100.0 + 86400
    assert [r.created for r in df.filter(clean.recent(F.col("created"), 1, now)).collect()] == [100.0]
    assert df.filter(clean.recent(F.col("created"), None, now)).count() == 4


def test_truncation_counts_code_points(spark):
    texts = ["x" * 18999, "x" * 19000, "x" * 19001, "\U0001f600" * 19005]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(text.truncated(F.col("t"), 1_000_000).alias("t"))
    assert [len(r.t) for r in df.collect()] == [18999, 19000, 19001, 19005]
    shorter = spark.createDataFrame([(t,) for t in texts], "t string").select(text.truncated(F.col("t")).alias("t"))
    assert [len(r.t) for r in shorter.collect()] == [18999, 19000, 19000, 19000]
    assert spark.createDataFrame([("abcdef",)], "t string").select(text.truncated(F.col("t"), 4)).first()[0] == "abcd"


def test_terms_need_every_word(spark):
    terms = ["red fox", "Fox", "fox fox", "quick-brown", "état", ""]
    texts = ["The RED,quick fox", "foxes are red", "État of the fox!", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.m for r in df.select("i", text.matched_terms(F.col("t"), terms).alias("m")).collect()}
    assert got == {0: ["red fox", "Fox", "fox fox"], 1: [], 2: ["Fox", "fox fox", "état"], 3: [], 4: []}
    assert df.select(text.matched_terms(F.col("t"), []).alias("m")).first().m == []


def test_terms_with_punctuation(spark):
    terms = ["so-called", "word's", "(((echo)))", "***", "a\u00a0b", "***", " ", "!!"]
    texts = ["a so called word's echo", "it is **** here", "b, a", "echo", "!", "!!"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.m for r in df.select("i", text.matched_terms(F.col("t"), terms).alias("m")).orderBy("i").collect()]
    assert got == [["so-called", "word's", "(((echo)))"], ["***"], ["a\u00a0b"], ["(((echo)))"], [], ["!!"]]


def test_token_estimate_and_prompt(spark):
    df = spark.createDataFrame([("abcdefg", "xyz1")], "p string, r string")
    assert df.select(text.token_estimate(F.col("p"), F.col("r"))).first()[0] == 2
    assert df.select(text.prompt(F.lit("p1"), F.col("p"))).first()[0] == "[Post ID: p1] abcdefg"


def test_schemas(spark):
    assert schemas.table_schema('{"properties": {"ID": {"type": "string"}, "n": {"type": "number"}, "l": {"type": "array"}}}').simpleString() == (
        "struct<id:string,n:double,l:array<string>>"
    )
    scores = schemas.scores_schema(["TOXICITY", "Threat"])
    assert scores.names[3:9] == ["post_id", "languages", "detected_languages", "toxicity_score", "toxicity_max_span_begin", "toxicity_max_span_end"]
    items = '{"type": "array", "items": {"properties": {"comment_id": {"type": "string"}, "is_bad": {"type": "boolean"}}}}'
    assert schemas.response_ddl(items) == "struct<comment_id:string,is_bad:boolean>"
    assert schemas.verdicts_schema("is_bad").names[3] == "is_bad"
