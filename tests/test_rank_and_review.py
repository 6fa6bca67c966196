import pytest
from pyspark.sql import functions as F

from threadwarden.operators import rank, review

ATTRIBUTES = ("toxicity", "insult", "threat")
NAN = float("nan")


@pytest.fixture(scope="module")
def scores(spark):
    rows = [("tie", 0.5, 0.5, 0.1), ("nan", NAN, 0.2, None), ("none", None, NAN, None), ("top", 0.1, 0.3, 0.9)]
    ddl = "post_id string, " + ", ".join(f"{a}_score double" for a in ATTRIBUTES)
    spans = {f"{a}_max_span_{e}": F.lit(float(10 * i + j)) for i, a in enumerate(ATTRIBUTES) for j, e in enumerate(("begin", "end"))}
    return spark.createDataFrame(rows, ddl).withColumns({**spans, "max_score": F.lit(99.0)})


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([("top", "T"), ("tie", "I"), ("tie", "again"), ("nan", "N"), ("unscored", "U")], "post_id string, full_conversation string")


def test_worst_attribute(scores):
    got = {r.post_id: (r.max_attribute, r.max_score, r.max_span_begin, r.max_span_end) for r in rank.with_worst_attribute(scores, ATTRIBUTES).collect()}
    assert got == {"tie": ("toxicity", 0.5, 0.0, 1.0), "nan": ("insult", 0.2, 10.0, 11.0), "none": (None, None, None, None), "top": ("threat", 0.9, 20.0, 21.0)}
    assert rank.score_attributes(scores) == list(ATTRIBUTES)


def test_highest_scores_attach_text_by_id(scores, conversations):
    rows = rank.highest_scores(scores, conversations.dropDuplicates(["post_id"]).filter("post_id <> 'nan'"), ATTRIBUTES).collect()
    assert [r.post_id for r in rows] == ["top", "tie", "nan", "none"]
    assert rows[0].full_text == "T" and rows[2].full_text is None


def test_content_columns():
    assert rank.content_column("Posts", []) == "selftext"
    assert rank.content_column("comments", ["body"]) == "body"
    assert rank.content_column("comments", ["body", "full_text_with_context"]) == "full_text_with_context"
    with pytest.raises(ValueError):
        rank.content_column("users", [])


def test_rank_multiplies_copies_and_drops_unmatched(scores, conversations):
    maxima = rank.with_worst_attribute(scores, ATTRIBUTES)
    got = rank.rank_conversations(conversations, maxima.unionByName(maxima.filter("post_id = 'top'")))
    assert [r.post_id for r in got.collect()] == ["top", "top", "tie", "tie", "nan"]


def test_attribute_filter(scores, conversations):
    maxima = rank.with_worst_attribute(scores, ATTRIBUTES)
    assert {r.post_id for r in rank.rank_conversations(conversations, maxima, ["Toxicity", "INSULT"]).collect()} == {"tie", "nan"}
    empty = rank.rank_conversations(conversations, maxima, ["profanity"])
    assert empty.columns == ["post_id", "full_conversation", "max_score", "max_attribute"]
    with pytest.warns(UserWarning, match="profanity"):
        assert rank.warn_if_empty(empty, ["profanity"]).count() == 0
    with pytest.raises(ValueError, match="list"):
        rank.keep_attributes(maxima, "toxicity")
    with pytest.raises(ValueError, match="max_attribute"):
        rank.rank_conversations(conversations, scores)


def test_filter_on_all_attributes_plans_quickly(spark):
    """All score columns derived from one text: the plan must not explode."""
    base = spark.createDataFrame([("p", "text")], "post_id string, t string")
    columns = [c for i, a in enumerate(rank.schemas.ATTRIBUTES) for c in (
        (F.length("t") / (i + 1)).alias(f"{a}_score"), F.length("t").cast("double").alias(f"{a}_max_span_begin"), F.lit(0.0).alias(f"{a}_max_span_end"))]
    maxima = rank.with_worst_attribute(base.select("post_id", *columns))
    assert rank.keep_attributes(maxima, ["toxicity"]).count() == 1


def test_positions_range_and_budget(scores):
    maxima = rank.with_worst_attribute(scores, ATTRIBUTES).filter("max_score is not null")
    narrow = maxima.select("post_id", "max_score")
    assert {r.post_id: r["rank"] for r in rank.rank_positions(narrow).collect()} == {"top": 0, "tie": 1, "nan": 2}
    assert tuple(rank.score_range(maxima).first()) == (0.2, 0.9, 3)
    assert [r.post_id for r in rank.shortlist(maxima, 2).collect()] == ["top", "tie"]
    for k in (None, 3):
        assert {r.post_id for r in rank.within_budget(narrow, F.lit(10), 25, k).collect()} == {"top", "tie"}
    assert [r.post_id for r in rank.within_budget(narrow, F.lit(10), 25, 1).collect()] == ["top"]


def test_account_rollup(spark):
    items = spark.createDataFrame([("a", True, 0.5, 1.0), ("a", False, 0.9, 3.0), ("a", None, None, 2.0), ("b", None, None, 7.0)], "author string, is_flagged boolean, max_score double, created double")
    got = {r.username: tuple(r)[1:] for r in review.account_rollup(items).collect()}
    assert got == {"a": (3, 2, 1, 0.5, 0.9, 3.0), "b": (1, 0, 0, None, None, 7.0)}


def test_suggestions(spark):
    df = spark.createDataFrame([("x",), ("x ",), ("",), (" ",), (None,), ("y",)], "suggested_prompt_modifications string")
    assert {tuple(r) for r in review.suggestion_rollup(df).collect()} == {("x", 2), ("y", 1)}


def test_glossary(spark):
    items = spark.createDataFrame([("1", "red and blue"), ("2", "blue"), ("3", "none")], "id string, body string")
    terms = spark.createDataFrame([("red",), ("blue",), ("blue",)], "term string")
    got = {r.id: (r.n_terms, r.terms, r.several_terms) for r in review.glossary_matches(items, F.col("body"), terms).collect()}
    assert got == {"1": (2, ["blue", "red"], True), "2": (1, ["blue"], False)}


def test_verdicts_with_source(spark):
    verdicts = spark.createDataFrame([("p", "c"), ("p", "zz")], "post_id string, comment_id string")
    comments = spark.createDataFrame([("c", "ann", "text")], "id string, author string, body string")
    posts = spark.createDataFrame([("p", "title", "bob")], "id string, title string, author string")
    got = {r.comment_id: (r.comment_author, r.post_title) for r in review.verdicts_with_source(verdicts, comments, posts).collect()}
    assert got == {"c": ("ann", "title"), "zz": (None, "title")}
