"""The whole chain, its incremental form and the driver contract."""

import os
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import example_tables as ex
import __spark_entry__ as contract
from threadwarden.operators import assess, rank
from threadwarden.plans.screening import Screening
from threadwarden.sources import ledger
from threadwarden.streaming.assessing import assess_stream

# workers cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SF = "/root/testdata/sf0.001"


def never():
    raise AssertionError("saved calls must be reused")


def test_screening_run_is_saved_and_goes_on(spark, folder):
    posts, comments = ex.thread_posts(spark, SF).withColumn("subreddit", F.lit("forum")), ex.thread_comments(spark, SF)
    run = Screening(spark, folder, ex.stand_in_toxicity, ex.stand_in_judge, backoff=0.0)
    run.run(posts=posts, comments=comments)
    conversations = {r.post_id: r.full_conversation for r in run.table("conversations").collect()}
    assert set(conversations) == {r.id for r in posts.collect()}
    ranked = run.rank().collect()
    assert all(conversations[r.post_id] == r.full_conversation for r in ranked)
    assert [r.max_score for r in ranked] == sorted((r.max_score for r in ranked), reverse=True)
    # every conversation ends as a score or as an error
    failed = {r.post_id for r in run.errors().filter("stage = 'score'").collect()}
    scored = {r.post_id for r in run.table("scores").collect()}
    assert failed | scored == set(conversations) and len(scored) == len(ranked)
    assert {r.subreddit for r in run.table("scores").collect()} == {"forum"}
    verdicts = run.table("verdicts")
    n_verdicts = verdicts.count()
    assert n_verdicts > 0 and {r.post_id for r in verdicts.collect()} <= scored
    assert run.totals().first().total_requests == len(ranked)

    again = Screening(spark, folder, never, never)
    again.run()
    assert again.table("verdicts").count() == n_verdicts
    assert [r.post_id for r in again.rank(["THREAT", "insult"], k=2).collect()] == [
        r.post_id for r in ranked if r.max_attribute in ("threat", "insult")
    ][:2]
    with pytest.raises(ValueError, match="Unknown stages"):
        again.run(["polish"])


def test_start_row_skips_the_first_conversations(spark, folder):
    run = Screening(spark, folder, ex.stand_in_toxicity, backoff=0.0)
    run.process(ex.thread_posts(spark, SF), ex.thread_comments(spark, SF))
    run.score(start_row=15)
    assert run.table("toxicity_calls").count() == 5
    run.score()
    assert run.table("toxicity_calls").count() == 20
    before = run.table("scores").count()
    run.score(retry_failed=True)
    assert run.table("scores").count() == before and run.table("toxicity_calls").count() > 20


def test_gathered_screening(spark, folder):
    posts = spark.createDataFrame(
        [(f"p{i}", "s1", f"red {i}", "text", "u", float(i)) for i in range(6)],
        "id string, subreddit string, title string, selftext string, author string, created double",
    )
    comments = spark.createDataFrame(
        [(f"c{i}", f"t3_p{i}", "body", "v", "s1", "", float(i)) for i in range(6)] + [("d", "t1_c5", "deep", "w", "s1", "", 9.0)],
        "id string, parent_id string, body string, author string, subreddit string, query string, created double",
    )
    config = spark.createDataFrame([(["s1", "s2"], ["red"])], "subreddits array<string>, search_terms array<string>")
    run = Screening(spark, folder)
    progress = {r.subreddit: tuple(r)[1:] for r in run.gather(posts, comments, config, now=100.0, num_posts=2).collect()}
    assert progress == {"s1": (2, 2, 3), "s2": (2, 0, 0)}
    assert sorted((r.id, r.query) for r in run.table("comments").collect()) == [("c4", "red"), ("c5", "red"), ("d", "red")]
    got = {r.post_id: r.full_conversation for r in run.process().collect()}
    assert set(got) == {"p4", "p5"} and "parent comment: c5" in got["p5"]


def test_stream_assesses_each_conversation_once(spark, folder):
    source = f"{folder}/in"
    documents = ex.document_conversations(spark, SF)
    documents.filter("cast(post_id as int) < 100").write.parquet(source)
    schema = documents.schema

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        query = assess_stream(stream, ex.stand_in_toxicity, f"{folder}/out", f"{folder}/check", backoff=0.0)
        assert query.awaitTermination(120)

    run()
    documents.filter("cast(post_id as int) >= 100").write.mode("append").parquet(source)
    run()
    run()
    got = spark.read.parquet(f"{folder}/out/scores").drop("batch", "subreddit").collect()
    batch = assess.flatten_scores(assess.score_conversations(documents, ex.stand_in_toxicity, backoff=0.0)).drop("subreddit").collect()
    assert sorted(got) == sorted(batch)
    assert sorted(os.listdir(f"{folder}/out/scores")) == ["batch=0", "batch=1"]


def test_entry_and_contract(spark):
    assert set(contract.ORACLES) == set(contract._QUERIES) and set(contract.oracle_sql()) <= set(contract.queries())
    flagship = contract.entry(spark)
    assert flagship.columns == ["post_id", "full_conversation", "max_score", "max_attribute"]
    assert flagship.count() > 0


def test_plans_prune_and_push_down(spark):
    listed = rank.shortlist(ex.document_scores(spark, SF).selectExpr("post_id", "toxicity_score as max_score"), 3)
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    tree = ex.thread_comments(spark, SF).filter("ord > 2").select("id")
    plan = tree._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(turn), GreaterThan(turn" in plan and "text" not in plan.split("ReadSchema")[1]


def sent_to_python(df):
    """The columns that the scorer's workers get, by the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapIn" not in plan
    return [re.sub(r"#\d+", "", sent) for sent in re.findall(r"ArrowEvalPython \[answer\((.*?)\)", plan)]


@pytest.mark.parametrize("name, sent", [("G4_verdicts_with_source", "prompt"), ("E1_composed_scores", "text"), ("E18_fabricated_verdicts", "prompt")])
def test_workers_of_a_query_get_one_column(spark, name, sent):
    assert sent_to_python(contract.queries()[name](spark, SF)) == [sent]


def test_batches_of_continued_calls_send_one_column(spark, monkeypatch):
    sent, commit = [], ledger.commit
    monkeypatch.setattr(ledger, "commit", lambda df, path, number: sent.append(sent_to_python(df)) or commit(df, path, number))
    contract.queries()["E8_continued_calls"](spark, SF)
    # three batches, four batches, and the verdicts parsed from them without Python
    assert sent == [["prompt"]] * 7 + [[]]
