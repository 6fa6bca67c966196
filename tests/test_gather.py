import pytest
from pyspark.sql import functions as F

from threadwarden.functions.text import post_text
from threadwarden.operators import gather

NOW = 1000 * 86400.0
DAY = 86400.0


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(f"p{i}", "s1" if i % 3 else "s2", f"Title {i}", "red fox" if i % 2 else "blue fox", f"u{i % 4}", float(i % 5), NOW - i * DAY) for i in range(30)]
    return spark.createDataFrame(rows, "id string, subreddit string, title string, selftext string, author string, score double, created double").withColumn("query", F.lit(""))


def ids(df):
    return {r.id for r in df.collect()}


def test_limit_comes_before_recency(posts):
    # the ten highest scores of s1 include old posts, which recency then removes
    got = gather.subreddit_posts(posts, "s1", NOW, 4, "top", days_back=10)
    assert ids(got) == {"p4"}
    assert gather.subreddit_posts(posts, "s1", NOW, 4, "top", days_back=None).count() == 4
    assert ids(gather.subreddit_posts(posts, "s1", NOW, 3, "new", days_back=2)) == {"p1", "p2"}


def test_unknown_and_unranked_sorts(posts):
    with pytest.raises(ValueError, match="Invalid sort_by"):
        gather.subreddit_posts(posts, "s1", NOW, sort_by="best")
    with pytest.raises(ValueError, match="sort_col"):
        gather.subreddit_posts(posts, "s1", NOW, sort_by="hot")
    assert gather.subreddit_posts(posts, "s1", NOW, 2, "hot", sort_col="score").count() == 2
    with pytest.raises(ValueError):
        gather.user_items(posts, "u1", NOW, sort_by="rising")


def test_search(posts):
    assert ids(gather.search_posts(posts, "FOX red", 3, "new")) == {"p1", "p3", "p5"}
    found = gather.search_subreddit_posts(posts, "s2", "red", NOW, 2, 5, "new", save_query=True)
    assert [(r.id, r.query) for r in found.collect()] == [("p3", "red")]
    assert gather.search_subreddit_posts(posts, "s2", "red", NOW, 2, 5, "new").first().query is None


def test_draw_plan(spark):
    names = spark.createDataFrame([("a",), ("b",)], "subreddit string")
    for wanted, parts in ((0, []), (40, [40]), (90, [40, 40, 10]), (200, [40] * 5)):
        rows = gather.plan_draws(names, wanted).filter("subreddit = 'a'").orderBy("draw").collect()
        assert [r.requested for r in rows] == parts


def test_terms_per_draw_repeat_with_the_seed(spark):
    names = spark.createDataFrame([(f"s{i}",) for i in range(20)], "subreddit string")
    terms = spark.createDataFrame([(0, "x"), (1, "y"), (2, "z")], "term_no int, term string")
    draws = gather.plan_draws(names, 200)
    one, again, other = (gather.assign_terms(draws, terms, seed).orderBy("subreddit", "draw").collect() for seed in (1, 1, 2))
    assert one == again != other
    assert len(one) == 100 and {r.query for r in one} == {"x", "y", "z"}


def test_gather_stamps_dedups_and_reports(spark, posts):
    draws = spark.createDataFrame([("s1", 0, 3, "red"), ("s1", 1, 2, "fox"), ("s2", 0, 1, "blue")], "subreddit string, draw int, requested int, query string")
    hits = gather.gather(posts, draws, NOW, days_back=4)
    assert sorted((r.id, r.draw, r.query) for r in hits.collect()) == [("p0", 0, "blue"), ("p1", 0, "red"), ("p1", 1, "fox"), ("p2", 1, "fox")]
    once = {r.id: (r.query, r.queries) for r in gather.dedup_hits(hits).collect()}
    assert once["p1"] == ("fox", ["fox", "red"]) and len(once) == 3
    comments = spark.createDataFrame([("c1", "p1", "s1", ""), ("c2", "p1", "s1", ""), ("c3", "p9", "s1", "")], "id string, post_id string, subreddit string, query string")
    stamped = gather.stamp_comments(comments, hits)
    assert sorted((r.id, r.query) for r in stamped.collect()) == [("c1", "fox"), ("c1", "red"), ("c2", "fox"), ("c2", "red")]
    progress = {r.subreddit: (r.requested, r.posts_saved, r.comments_saved) for r in gather.gather_progress(draws, hits, stamped).collect()}
    assert progress == {"s1": (5, 3, 4), "s2": (1, 1, 0)}


def test_gather_of_nothing(spark, posts):
    draws = spark.createDataFrame([], "subreddit string, draw int, requested int, query string")
    assert gather.gather(posts, draws, NOW).count() == 0


def test_words_of_no_term_are_dropped_before_anything_is_shuffled(spark, capsys):
    posts = spark.createDataFrame([("a", "x y **** z"), ("a", "y x"), ("a", "x"), ("b", "x -- *"), ("c", None)], "id string, t string")
    # terms out of an RDD: Spark cannot tell their size
    terms = spark.createDataFrame(spark.sparkContext.parallelize([("x y",), ("***",), ("--",), ("Z x",)]), "term string")
    found = gather.term_matches_by_join(posts, F.col("t"), terms)
    assert sorted(tuple(r) for r in found.collect()) == [("a", "***"), ("a", "Z x"), ("a", "x y"), ("b", "--")]
    found.explain()
    plan = capsys.readouterr().out
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_both_ways_to_match_terms_agree(spark, posts):
    terms = spark.createDataFrame([("red fox",), ("BLUE",), ("title 7",), ("fox fox",), ("none of these",), ("red-fox",), ("blue\u00a0fox",), ("***",), (" ",)], "term string")
    text = post_text(F.col("title"), F.col("selftext"))
    inline = sorted(tuple(r) for r in gather.term_matches(posts, text, terms).collect())
    joined = sorted(tuple(r) for r in gather.term_matches_by_join(posts, text, terms).collect())
    assert inline == joined and ("p7", "title 7") in inline and ("p0", "blue\u00a0fox") in inline
    # rows under one key: a term must be met within one of them
    pairs = spark.createDataFrame([("k", "red"), ("k", "fox"), ("k", "red * fox"), ("k", "red fox")], "id string, t string")
    forms = [f(pairs, F.col("t"), terms).collect() for f in (gather.term_matches, gather.term_matches_by_join)]
    assert sorted(map(tuple, forms[0])) == sorted(map(tuple, forms[1])) == [("k", "fox fox"), ("k", "red fox"), ("k", "red-fox")]


def test_long_term_lists_are_joined(spark, posts, monkeypatch):
    monkeypatch.setattr(gather, "MAX_INLINE_TERMS", 1)
    terms = spark.createDataFrame([("red fox",), ("title 7",)], "term string")
    text = post_text(F.col("title"), F.col("selftext"))
    assert gather.term_matches(posts, text, terms).count() == 16


def test_users(spark, posts):
    assert gather.user_lookup(posts, "nobody").count() == 0
    assert [r.username for r in gather.user_lookup(posts, "u1").collect()] == ["u1"]
    assert ids(gather.user_items(posts, "u1", NOW, 3)) == {"p1", "p5", "p9"}
    assert ids(gather.user_items(posts, "u1", NOW, 3, "new", 6)) == {"p1", "p5"}
    every = gather.all_user_items(posts, NOW, 2)
    assert ids(every) == {f"p{i}" for i in range(8)}
    chosen = spark.createDataFrame([("u0",), ("u0",), ("zz",)], "author string")
    assert ids(gather.all_user_items(posts, NOW, 2, users=chosen)) == {"p0", "p4"}
