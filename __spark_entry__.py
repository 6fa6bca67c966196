
from __future__ import annotations

import json
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import example_tables as ex
import threadwarden
from oracle_tables import ORACLES
from threadwarden import schemas
from threadwarden.functions import clean, scores, text
from threadwarden.operators import assess, distributed, gather, rank, review, threads
from threadwarden.sources import staging, tables

# The scorers run in Python workers, which need not have this folder on their path.
cloudpickle.register_pickle_by_value(threadwarden)
cloudpickle.register_pickle_by_value(ex)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        _QUERIES[name] = fn
        return fn

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Threads rebuilt from posts and comments, ranked by their worst attribute."""
    return ranked_threads(spark, "/root/testdata/sf0.001")


def _llm() -> tuple[dict[str, Query], dict[str, str]]:
    """Queries and SQL of the llm subpackage; none if it cannot be imported."""
    try:
        import corpus_pipeline
        from threadwarden.llm import queries as llm
    except ImportError:
        return {}, {}
    pipeline_sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**llm.QUERIES, "pipeline": corpus_pipeline.run}, {**llm.ORACLES, **pipeline_sql}


def queries() -> dict[str, Query]:
    return {**_QUERIES, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**ORACLES, **_llm()[1]}


# ---- A: scans, sources, sinks ----


@query("A1_csv_scan")
def csv_scan(spark, sf_dir):
    """CSV holding every document and null-like cells, read back with null rules."""
    path = staging.new_stage_path(spark, "csv")
    cells = ex.table(spark, sf_dir, "documents").select(
        "doc_id", F.col("text").alias("BODY"), F.expr("case lang when 'de' then 'NA' when 'fr' then '' when 'es' then 'None' else lang end").alias("Lang")
    )
    tables.write_csv(cells, path)
    return tables.read_csv(spark, path, "doc_id bigint, body string, lang string")


@query("A2_header_promotion")
def header_promotion(spark, sf_dir):
    shouted = ex.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("DOC_ID"), F.col("toxic").alias("Toxic"))
    return clean.lower_header(shouted)


@query("A3_schema_file")
def schema_file(spark, sf_dir):
    """Documents under a table schema read from JSON text."""
    kinds = {"id": "string", "subreddit": "string", "score": "number", "created": "integer", "over_18": "boolean"}
    schema = schemas.table_schema(json.dumps({"properties": {k: {"type": v} for k, v in kinds.items()}}))
    return tables.conform(ex.document_posts(spark, sf_dir), schema)


@query("A4_generated_scores_schema")
def generated_scores_schema(spark, sf_dir):
    return tables.conform(ex.document_scores(spark, sf_dir), schemas.scores_schema())


@query("A5_config_scan")
def config_scan(spark, sf_dir):
    """A targeting file with the sources as communities, written and read back."""
    path = staging.new_stage_path(spark, "config")
    communities = ex.table(spark, sf_dir, "documents").agg(F.array_sort(F.collect_set("source")).alias("subreddits"))
    communities.select(
        "subreddits",
        F.array(*[F.lit(t) for t in ex.TERMS]).alias("search_terms"),
        F.map_from_arrays(
            F.array(*[F.lit(a.upper()) for a in schemas.ATTRIBUTES]),
            F.array(*[F.struct(F.lit("PROBABILITY").alias("scoreType")) for _ in schemas.ATTRIBUTES]),
        ).alias("requestedAttributes"),
    ).write.json(path)
    config = tables.read_config(spark, path)
    named = [
        tables.config_subreddits(config).select(F.lit("subreddit").alias("kind"), F.col("subreddit").alias("name")),
        tables.config_terms(config).select(F.lit("term").alias("kind"), F.col("term").alias("name")),
        tables.config_attributes(config).select(F.lit("attribute").alias("kind"), F.col("attribute").alias("name")),
    ]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("A6_prompt_asset")
def prompt_asset(spark, sf_dir):
    """An instruction text kept in a file, put beside every conversation."""
    path = staging.new_stage_path(spark, "asset")
    spark.createDataFrame([("Judge each comment.\nAnswer as a list.",)], "value string").coalesce(1).write.text(path)
    instruction = tables.read_asset(spark, path)
    return ex.document_conversations(spark, sf_dir).select("post_id", F.lit(instruction.strip()).alias("system_instruction"))


@query("A7_aligned_append")
def aligned_append(spark, sf_dir):
    """Rows of two shapes appended under the first one's columns."""
    path = staging.new_stage_path(spark, "append")
    documents = ex.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("DOC_ID"), "source", "n_chars")
    for number in (0, 0):  # a writer that does not know whether its append stands repeats it
        tables.append_aligned(documents, path, number=number)
    tables.append_aligned(ex.table(spark, sf_dir, "labels").select("toxic", "doc_id"), path)
    return tables.read_appended(spark, path)


@query("A8_csv_sink")
def csv_sink(spark, sf_dir):
    """Rebuilt conversation texts keep their blanks and line breaks through CSV."""
    path = staging.new_stage_path(spark, "csv")
    tables.write_csv(composed(spark, sf_dir), path)
    return tables.read_csv(spark, path, "post_id string, part bigint, full_conversation string")


@query("A9_entity_json_sink")
def entity_json_sink(spark, sf_dir):
    path = staging.new_stage_path(spark, "entities")
    posts = ex.document_posts(spark, sf_dir).select("id", "subreddit", "selftext", "created")
    tables.write_entities(posts, path)
    return tables.read_entities(spark, path, posts.schema).select("id", "subreddit", "selftext", "created")


@query("A10_materialize_once")
def materialize_once(spark, sf_dir):
    """The second build would differ, but the saved table is returned."""
    path = staging.new_stage_path(spark, "once")
    documents = ex.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    tables.materialize(spark, path, lambda: documents)
    return tables.materialize(spark, path, lambda: documents.withColumn("n_chars", F.lit(0)))


@query("A11_input_fallback")
def input_fallback(spark, sf_dir):
    ranked, plain = staging.new_stage_path(spark, "ranked"), staging.new_stage_path(spark, "plain")
    ex.document_conversations(spark, sf_dir).write.parquet(plain)
    return tables.first_existing(spark, ranked, plain)


# ---- B: gathering ----


@query("B1_subreddit_listing")
def subreddit_listing(spark, sf_dir):
    posts = ex.document_posts(spark, sf_dir)
    return gather.subreddit_posts(posts, "src3", ex.NOW, num_posts=20, sort_by="top", days_back=29.8).select("id", "score", "created")


@query("B2_global_search")
def global_search(spark, sf_dir):
    return gather.search_posts(ex.document_posts(spark, sf_dir), "The OF", 25, "new").select("id", "created")


@query("B3_subreddit_search")
def subreddit_search(spark, sf_dir):
    found = gather.search_subreddit_posts(
        ex.document_posts(spark, sf_dir), "src5", "the of", ex.NOW, 15, 29.7, "new", save_query=True
    )
    return found.select("id", "created", "query")


def _draws(spark, sf_dir, num_posts=90):
    communities = ex.table(spark, sf_dir, "documents").select(F.col("source").alias("subreddit")).distinct()
    planned = gather.plan_draws(communities, num_posts)
    by_name = F.expr("cast(substring(subreddit, 4) as int) + draw")
    return gather.assign_terms(planned, ex.terms_table(spark), pick=by_name)


@query("B4_batched_search")
def batched_search(spark, sf_dir):
    found = gather.gather(ex.document_posts(spark, sf_dir), _draws(spark, sf_dir), ex.NOW, days_back=29.9)
    return found.select("id", "subreddit", "draw", "query", "created")


@query("B5_term_match")
def term_match(spark, sf_dir):
    body = text.post_text(F.col("title"), F.col("selftext"))
    return gather.term_matches(ex.document_posts(spark, sf_dir), body, ex.terms_table(spark))


@query("B5_term_match_by_join")
def term_match_by_join(spark, sf_dir):
    body = text.post_text(F.col("title"), F.col("selftext"))
    return gather.term_matches_by_join(ex.document_posts(spark, sf_dir), body, ex.terms_table(spark))


@query("B6_comments_of_posts")
def comments_of_posts(spark, sf_dir):
    """Comments at any depth below posts written by the user role, the latest days only."""
    posts = ex.thread_posts(spark, sf_dir)
    comments = ex.thread_comments(spark, sf_dir).withColumn("created", F.col("ord") * 86_400.0)
    chosen = posts.filter(F.col("author") == "user")
    return threads.comments_of_posts(threads.reach_comments(chosen, comments), chosen, comments, 7 * 86_400.0, 5).select("id", "post_id", "depth", "body")


@query("B7_user_lookup")
def user_lookup(spark, sf_dir):
    items = ex.event_items(spark, sf_dir)
    return gather.user_lookup(items, "8").unionByName(gather.user_lookup(items, "nobody"))


@query("B8_user_posts")
def user_posts(spark, sf_dir):
    now = 1_706_659_200.0
    return gather.user_items(ex.event_items(spark, sf_dir), "8", now, 20, "new", 10).select("id", "author", "created")


@query("B8_posts_of_all_users")
def posts_of_all_users(spark, sf_dir):
    return gather.all_user_items(ex.event_items(spark, sf_dir), 1_706_659_200.0, 5, "new", 2).select("id", "author", "created")


@query("B9_user_comments")
def user_comments(spark, sf_dir):
    items = ex.event_items(spark, sf_dir)
    known = items.filter(F.col("subreddit") == "signup").select("author")
    return gather.all_user_items(items, 1_706_659_200.0, 3, "top", None, users=known).select("id", "author", "score", "body")


@query("B10_draw_plan")
def draw_plan(spark, sf_dir):
    communities = ex.table(spark, sf_dir, "documents").select(F.col("source").alias("subreddit")).distinct()
    return gather.plan_draws(communities, 90)


@query("B11_term_per_draw")
def term_per_draw(spark, sf_dir):
    return _draws(spark, sf_dir, 200)


@query("B12_query_lineage")
def query_lineage(spark, sf_dir):
    """Thread comments stamped with the terms found in their post."""
    posts, comments = ex.thread_posts(spark, sf_dir), ex.thread_comments(spark, sf_dir)
    body = text.post_text(F.col("title"), F.col("selftext"))
    found = gather.term_matches(posts, body, ex.terms_table(spark)).withColumnRenamed("term", "query")
    members = threads.comments_of_posts(threads.link_comments(comments), posts, comments)
    return gather.stamp_comments(members, found).select("id", "post_id", "query")


@query("B13_recency_cutoff")
def recency_cutoff(spark, sf_dir):
    items = ex.event_items(spark, sf_dir)
    return items.filter(clean.recent(F.col("created"), 7, 1_706_659_200.0)).select("id", "created")


@query("B14_duplicate_control")
def duplicate_control(spark, sf_dir):
    hits = gather.gather(ex.document_posts(spark, sf_dir), _draws(spark, sf_dir, 200), ex.NOW)
    return gather.dedup_hits(hits).select("id", "query", F.array_join("queries", "|").alias("queries"))


@query("B15_gather_progress")
def gather_progress(spark, sf_dir):
    draws = _draws(spark, sf_dir)
    hits = gather.gather(ex.document_posts(spark, sf_dir), draws, ex.NOW)
    comments = ex.table(spark, sf_dir, "labels").join(
        ex.table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("subreddit")), "doc_id"
    )
    return gather.gather_progress(draws, hits, comments)


# ---- C: projections, filters, cleaning ----


def _raw_records(spark, sf_dir):
    return ex.table(spark, sf_dir, "documents").select(
        F.struct(F.col("source").alias("display_name")).alias("subreddit"),
        F.when(F.col("lang") != "de", F.struct(F.col("lang").alias("name"))).alias("author"),
        F.create_map(F.concat(F.lit("c"), "doc_id"), F.lit("x"), F.concat(F.lit("d"), "doc_id"), F.lit("y")).alias("_comments_by_id"),
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("selftext"),
        F.col("text").alias("selftext_html"),
        (F.col("doc_id") * 60.0 + 1_700_000_000).alias("created_utc"),
        (F.col("doc_id") * 60.0 + 1_700_000_000).alias("created"),
        F.lit("kept out").alias("permalink"),
    )


@query("C1_C2_C7_clean_records")
def clean_records(spark, sf_dir):
    return clean.clean_records(_raw_records(spark, sf_dir)).withColumn("_comments_by_id", F.array_join("_comments_by_id", ","))


@query("C3_C5_nested_to_scalar")
def nested_to_scalar(spark, sf_dir):
    return clean.scalar_fields(_raw_records(spark, sf_dir)).select(
        "id", "subreddit", "author", F.explode("_comments_by_id").alias("comment_key")
    )


@query("C4_epoch_text")
def epoch_text(spark, sf_dir):
    return clean.scalar_fields(_raw_records(spark, sf_dir)).select("id", "created_utc")


def _patchy_posts(spark, sf_dir):
    return ex.document_posts(spark, sf_dir).select(
        "id",
        F.expr("case when title like 'de%' then 'N/A' else title end").alias("title"),
        F.expr("case when length(selftext) < 200 then 'nan' else selftext end").alias("selftext"),
        F.expr("case author when 'fr' then '<NA>' else author end").alias("author"),
    )


@query("C6_placeholder_fill")
def placeholder_fill(spark, sf_dir):
    return clean.fill_posts(clean.nulls_from_tokens(_patchy_posts(spark, sf_dir)))


@query("C8_null_tokens")
def null_tokens(spark, sf_dir):
    return clean.nulls_from_tokens(_patchy_posts(spark, sf_dir))


@query("C9_required_columns")
def required_columns(spark, sf_dir):
    posts = ex.document_posts(spark, sf_dir)
    return clean.require_columns(posts, threads.POST_COLUMNS, "posts").select(*threads.POST_COLUMNS)


@query("C10_parent_decode")
def parent_decode(spark, sf_dir):
    odd = F.when(F.col("author") != "system", F.col("parent_id"))
    comments = ex.thread_comments(spark, sf_dir).withColumn("parent_id", F.when(F.col("ord") < 6, odd).otherwise("x9_odd"))
    return threads.decode_parents(comments).select("id", "parent_kind", "parent_key")


@query("C11_membership_ignoring_case")
def membership(spark, sf_dir):
    documents = ex.table(spark, sf_dir, "documents")
    return documents.filter(clean.member_ignoring_case(F.upper("lang"), ["DE", "Fr"])).select("doc_id", "lang")


@query("C12_scored_text")
def scored_text(spark, sf_dir):
    return ex.document_posts(spark, sf_dir).select("id", text.post_text(F.col("title"), F.col("selftext")).alias("scored_text"))


@query("C13_C14_truncated_text")
def truncated_text(spark, sf_dir):
    known = F.when(F.col("post_id") != "3", F.col("full_conversation"))
    return assess.prepare(ex.document_conversations(spark, sf_dir).withColumn("full_conversation", known))


@query("C15_token_estimate")
def token_estimate(spark, sf_dir):
    return ex.document_posts(spark, sf_dir).select(
        "id", text.token_estimate(F.col("selftext"), F.col("title")).alias("tokens")
    )


@query("C16_prompt")
def prompt(spark, sf_dir):
    return assess.prepare_prompts(ex.document_conversations(spark, sf_dir)).select("post_id", "prompt")


@query("C17_C18_stable_id")
def stable_id(spark, sf_dir):
    return ex.document_conversations(spark, sf_dir).select(
        "post_id",
        text.stable_id(F.lit(assess.SHEET_NAME), F.col("post_id")).alias("perspective_id"),
        F.lit(assess.SHEET_NAME).alias("sheet_name"),
    )


# ---- D: threads ----


def composed(spark, sf_dir, **options):
    return threads.compose(ex.thread_posts(spark, sf_dir), ex.thread_comments(spark, sf_dir), **options)


@query("D1_top_level_comments")
def top_level_comments(spark, sf_dir):
    found = threads.top_level_comments(ex.thread_posts(spark, sf_dir), ex.thread_comments(spark, sf_dir))
    return found.select("id", "post_id")


@query("D2_reply_tree")
def reply_tree(spark, sf_dir):
    return threads.link_comments(ex.thread_comments(spark, sf_dir)).select("id", "post_id", "parent_comment_id", "depth")


@query("D2_deep_tree_in_one_thread")
def deep_tree(spark, sf_dir):
    """Every event below one post: the hottest thread there can be."""
    return threads.link_comments(ex.event_comments(spark, sf_dir)).select("id", "post_id", "parent_comment_id", "depth")


@query("D3_node_lines")
def node_lines(spark, sf_dir):
    """The lines of each comment under its place in the tree."""
    comments = ex.thread_comments(spark, sf_dir)
    placed = threads.link_comments(comments).select("id", "depth", "parent_comment_id").join(comments, "id")
    lines = threads.comment_lines(*[F.col(c) for c in ("id", "author", "body", "depth", "parent_comment_id")])
    return placed.select("id", lines.alias("lines"))


@query("D4_reading_order")
def reading_order(spark, sf_dir):
    """Character offset and place of every line of the one big thread."""
    tree = threads.link_comments(ex.event_comments(spark, sf_dir), sizes=True)
    placed = threads.place_lines(ex.event_posts(spark, sf_dir), tree)
    return placed.filter("depth >= 0").select("post_id", "id", "depth", "offset", "n_comments")


@query("D5_post_header")
def post_header(spark, sf_dir):
    posts = clean.fill_posts(ex.thread_posts(spark, sf_dir))
    header = threads.post_header(*[F.col(c) for c in ("id", "title", "selftext", "author")])
    return posts.select(F.col("id").alias("post_id"), header.alias("header"))


@query("D6_empty_threads")
def empty_threads(spark, sf_dir):
    """Every document as a post; comments answer some of them only."""
    return threads.compose(ex.document_posts(spark, sf_dir), _rated(spark, sf_dir))


def _rated(spark, sf_dir):
    return ex.table(spark, sf_dir, "labels").select(
        F.concat(F.lit("c"), "doc_id").alias("id"),
        F.concat(F.lit("t3_"), "doc_id").alias("parent_id"),
        F.concat(F.lit("quality "), "quality").alias("body"),
        F.lit("rater").alias("author"),
        F.col("doc_id").alias("ord"),
    )


@query("D7_compose_conversations")
def compose_conversations(spark, sf_dir):
    return composed(spark, sf_dir)


@query("D7_compose_big_thread_in_parts")
def compose_big_thread(spark, sf_dir):
    return threads.compose(ex.event_posts(spark, sf_dir), ex.event_comments(spark, sf_dir), part_chars=50_000)


@query("D7_conversation_beginnings")
def conversation_beginnings(spark, sf_dir):
    """What a model reads of each conversation."""
    posts, comments = ex.event_posts(spark, sf_dir), ex.event_comments(spark, sf_dir)
    return threads.compose(posts, comments, max_chars=text.CONTEXT_LIMIT)


@query("D8_unreached_comments")
def unreached_comments(spark, sf_dir):
    """Posts of the system role are missing, and so is every comment number 2; some others lead nowhere or round."""
    posts = ex.thread_posts(spark, sf_dir).filter("author <> 'system'")
    comments = ex.thread_comments(spark, sf_dir).filter("ord <> 2")
    thread = F.split("id", "_")[0].cast("int")
    around = F.concat(F.lit("t1_"), F.split("id", "_")[0], F.lit("_7"))
    parent = F.when((F.col("ord") == 3) & (thread % 5 == 0), around).when((F.col("ord") == 4) & (thread % 7 == 0), "x9_odd")
    comments = comments.withColumn("parent_id", F.coalesce(parent, "parent_id"))
    return threads.unreached_comments(posts, comments, threads.link_comments(comments))


@query("D9_duplicates_kept_once")
def duplicates_once(spark, sf_dir):
    posts, comments = ex.thread_posts(spark, sf_dir), ex.thread_comments(spark, sf_dir)
    later = comments.withColumns({"ord": F.col("ord") + 100, "body": F.lit("a later copy")})
    return threads.compose(posts.unionByName(posts), comments.unionByName(later))


@query("D9_duplicates_repeated")
def duplicates_repeated(spark, sf_dir):
    """First-level comments held twice: each copy brings its replies again."""
    posts, comments = ex.thread_posts(spark, sf_dir), ex.thread_comments(spark, sf_dir)
    copies = comments.filter("ord < 3").withColumns({"ord": F.col("ord") + 100, "body": F.lit("a later copy")})
    return threads.compose(posts, comments.unionByName(copies), duplicates="repeat")


# ---- E: assessment ----


def _calls(spark, sf_dir):
    options = {"tasks": spark.sparkContext.defaultParallelism, "backoff": 0.0}
    known = ex.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("subreddit"), F.col("text").alias("full_conversation")
    )
    return assess.score_conversations(known, ex.stand_in_toxicity, **options)


def _judged(spark, sf_dir):
    options = {"tasks": spark.sparkContext.defaultParallelism, "backoff": 0.0}
    return assess.judge_conversations(ex.document_conversations(spark, sf_dir), ex.stand_in_judge, **options)


@query("E1_E9_toxicity_scores")
def toxicity_scores(spark, sf_dir):
    return assess.flatten_scores(_calls(spark, sf_dir))


@query("E2_E11_verdicts")
def verdicts(spark, sf_dir):
    return assess.parse_verdicts(_judged(spark, sf_dir))


@query("E6_retry_once")
def retry_once(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    return calls.select("post_id", "attempts", F.size("errors").alias("n_errors"), F.col("response_json").isNotNull().alias("answered"))


@query("E7_E15_error_rows")
def error_rows(spark, sf_dir):
    return assess.error_rows(_calls(spark, sf_dir)).drop("at")


@query("E8_batch_slices")
def batch_slices(spark, sf_dir):
    ids = ex.table(spark, sf_dir, "documents").select("doc_id")
    return assess.batch_slices(ids, ["doc_id"], 50, 120)


@query("E8_resume")
def resume(spark, sf_dir):
    done = ex.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("post_id"))
    return assess.not_yet_done(ex.document_conversations(spark, sf_dir), done).select("post_id")


@query("E8_continued_calls")
def continued_calls(spark, sf_dir):
    """Labelled documents are judged first, then all, labelled ones twice: each row is answered once."""
    path = staging.new_stage_path(spark, "calls")
    conversations = ex.document_conversations(spark, sf_dir)
    items = assess.prepare_prompts(conversations)
    labelled = ex.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("post_id")).distinct()
    first = assess.prepare_prompts(distributed.semi_join_stored(conversations, labelled, "post_id"))
    assess.continue_calls(first, path, ex.stand_in_judge, send="prompt", batches=3)
    calls = assess.continue_calls(items.unionByName(first), path, ex.stand_in_judge, send="prompt", batches=4)
    parsed = assess.parse_new_calls(spark, path, staging.new_stage_path(spark, "verdicts"), assess.parse_verdicts)
    n_verdicts = parsed.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_verdicts"))
    answered = calls.groupBy("post_id").agg(F.count(F.lit(1)).alias("n_calls"), F.max("copy").alias("last_copy"))
    return answered.join(n_verdicts, "post_id", "left").withColumn("n_verdicts", F.coalesce("n_verdicts", F.lit(0)))


@query("E1_composed_scores")
def composed_scores(spark, sf_dir):
    """Documents as posts, raters' comments below them, composed and scored: the community is passed on."""
    known = threads.compose(ex.document_posts(spark, sf_dir), _rated(spark, sf_dir), keep=["subreddit"]).filter("part = 0")
    calls = assess.score_conversations(known, ex.stand_in_toxicity, tasks=spark.sparkContext.defaultParallelism, backoff=0.0)
    return assess.flatten_scores(calls).select("perspective_id", "subreddit", "post_id", "toxicity_score", "threat_score")


@query("E10_best_span")
def best_span(spark, sf_dir):
    """Words of a text as spans scored by length modulo 5, so that ties abound."""
    words = F.split("text", " ")
    spans = F.transform(
        words,
        lambda w, i: F.struct(i.alias("begin"), (i + F.length(w)).alias("end"), F.struct((F.length(w) % 5).cast("double").alias("value")).alias("score")),
    )
    best = scores.best_span(F.col("spans"))
    return (
        ex.table(spark, sf_dir, "documents")
        .select("doc_id", spans.alias("spans"))
        .select("doc_id", best["score"].alias("score"), best["begin"].alias("span_begin"), best["end"].alias("span_end"))
    )


@query("E12_ranked_attributes")
def ranked_attributes(spark, sf_dir):
    ranked = assess.ranked_attributes(_calls(spark, sf_dir))
    each = ranked.select("post_id", "max_score", "max_score_attribute", F.posexplode("scores").alias("position", "entry"))
    return each.select(
        "post_id", "max_score", "max_score_attribute", "position",
        F.col("entry.attribute").alias("attribute"),
        F.col("entry.summary_score").alias("summary_score"),
        F.array_join(F.transform("entry.spans", lambda s: s["text"]), "|").alias("span_texts"),
    )


@query("E13_languages")
def languages(spark, sf_dir):
    scored = assess.flatten_scores(_calls(spark, sf_dir), ("toxicity",))
    return scored.groupBy("languages", "detected_languages").agg(F.count(F.lit(1)).alias("n"))


@query("E14_unparseable_responses")
def unparseable(spark, sf_dir):
    broken = assess.parse_error_rows(_calls(spark, sf_dir)).drop("at")
    return broken.unionByName(assess.verdict_error_rows(_judged(spark, sf_dir)).drop("at"))


@query("E16_run_totals")
def run_totals(spark, sf_dir):
    return assess.run_totals(_judged(spark, sf_dir))


def _comment_table(spark, sf_dir):
    """Comments c0, c1, ... made of documents: some deleted or removed."""
    return ex.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("c"), "doc_id").alias("id"),
        F.expr("if(lang = 'de', '[deleted]', lang)").alias("author"),
        F.expr("if(lang = 'fr', '[removed]', text)").alias("body"),
        F.concat(F.lit("t3_"), "doc_id").alias("parent_id"),
        F.col("doc_id").alias("ord"),
    )


@query("E17_missing_data_rules")
def missing_data_rules(spark, sf_dir):
    found = assess.parse_verdicts(_judged(spark, sf_dir))
    ruled = assess.apply_missing_data_rules(found, _comment_table(spark, sf_dir))
    return ruled.select("gemini_id", "post_id", "user_id", "comment_id", "is_flagged")


@query("E18_fabricated_verdicts")
def fabricated_verdicts(spark, sf_dir):
    tree = threads.link_comments(_comment_table(spark, sf_dir))
    found = assess.parse_verdicts(_judged(spark, sf_dir))
    return assess.fabricated_verdicts(found, tree).select("gemini_id", "post_id", "comment_id")


# ---- F: ranking ----


def _maxima(spark, sf_dir):
    return rank.with_worst_attribute(ex.document_scores(spark, sf_dir))


@query("F1_F2_row_maximum")
def row_maximum(spark, sf_dir):
    """NaN and null scores are skipped."""
    scored = ex.document_scores(spark, sf_dir)
    gaps = {"insult_score": F.lit(float("nan")), "threat_score": F.lit(None).cast("double")}
    scored = scored.withColumns({**gaps, "max_score": F.lit(2.0)})
    columns = [f"{a}_score" for a in rank.score_attributes(scored)]
    return scored.select("post_id", scores.row_max(columns).alias("highest"))


@query("F3_F4_worst_attribute")
def worst_attribute(spark, sf_dir):
    return _maxima(spark, sf_dir).select("post_id", "max_attribute", "max_score", "max_span_begin", "max_span_end")


@query("F5_F6_attached_text")
def attached_text(spark, sf_dir):
    source = ex.document_conversations(spark, sf_dir).filter("post_id <> '5'")
    return rank.attach_text(ex.document_scores(spark, sf_dir).select("post_id", "toxicity_score"), source)


@query("F7_highest_scores")
def highest_scores(spark, sf_dir):
    return rank.highest_scores(ex.document_scores(spark, sf_dir), ex.document_conversations(spark, sf_dir))


@query("F8_rank_conversations")
def rank_conversations(spark, sf_dir):
    return rank.rank_conversations(ex.document_conversations(spark, sf_dir), _maxima(spark, sf_dir))


@query("F8_ranked_threads")
def ranked_threads(spark, sf_dir):
    """The flagship: threads rebuilt, scored by the stand-in, ranked by worst attribute.

    Small threads, and all events as one thread that is far longer than a part: each post is
    scored once, by the beginning that the classifier reads.
    """
    posts = ex.thread_posts(spark, sf_dir).unionByName(ex.event_posts(spark, sf_dir))
    comments = ex.thread_comments(spark, sf_dir).unionByName(ex.event_comments(spark, sf_dir))
    beginnings = threads.compose(posts, comments, part_chars=5_000, max_chars=text.CONTEXT_LIMIT)
    conversations = staging.stage(beginnings.select("post_id", "full_conversation"), "conversations")
    calls = staging.stage(assess.score_conversations(conversations, ex.stand_in_toxicity, backoff=0.0), "calls")
    maxima = rank.with_worst_attribute(assess.flatten_scores(calls))
    return rank.rank_conversations(conversations, maxima)


@query("F9_attribute_filter")
def attribute_filter(spark, sf_dir):
    wanted = ["TOXICITY", "Threat"]
    return rank.rank_conversations(ex.document_conversations(spark, sf_dir), _maxima(spark, sf_dir), wanted)


@query("F9_attribute_filter_without_match")
def attribute_filter_empty(spark, sf_dir):
    return rank.rank_conversations(ex.document_conversations(spark, sf_dir), _maxima(spark, sf_dir), ["no_such"])


@query("F10_rank_positions")
def rank_positions(spark, sf_dir):
    return rank.rank_positions(_maxima(spark, sf_dir).select("post_id", "max_score"))


@query("F11_score_range")
def score_range(spark, sf_dir):
    return rank.score_range(_maxima(spark, sf_dir))


@query("F12_shortlist")
def shortlist(spark, sf_dir):
    return rank.shortlist(_maxima(spark, sf_dir), 50).select("post_id", "max_score", "max_attribute")


@query("F12_token_budget")
def token_budget(spark, sf_dir):
    maxima = _maxima(spark, sf_dir).join(ex.document_conversations(spark, sf_dir), "post_id")
    estimate = F.floor(F.length("full_conversation") / 4)
    taken = rank.within_budget(maxima.select("post_id", "max_score", "full_conversation"), estimate, 100_000)
    return taken.select("post_id", "max_score", "tokens", "spent_before")


# ---- G: review ----


@query("G1_account_rollup")
def account_rollup(spark, sf_dir):
    labels = ex.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("id"), (F.col("toxic") == 1).alias("is_flagged"))
    maxima = _maxima(spark, sf_dir).select(F.col("post_id").alias("id"), "max_score")
    posts = ex.document_posts(spark, sf_dir).select("id", F.col("subreddit").alias("author"), "created")
    return review.account_rollup(posts.join(labels, "id", "left").join(maxima, "id", "left"))


@query("G2_suggestion_rollup")
def suggestion_rollup(spark, sf_dir):
    return review.suggestion_rollup(assess.parse_verdicts(_judged(spark, sf_dir)))


@query("G3_glossary_matches")
def glossary_matches(spark, sf_dir):
    found = review.glossary_matches(ex.document_posts(spark, sf_dir), F.col("selftext"), ex.terms_table(spark))
    return found.withColumn("terms", F.array_join("terms", "|"))


@query("G4_verdicts_with_source")
def verdicts_with_source(spark, sf_dir):
    found = assess.parse_verdicts(_judged(spark, sf_dir)).select("gemini_id", "post_id", "comment_id", "is_flagged")
    return review.verdicts_with_source(found, _comment_table(spark, sf_dir), ex.document_posts(spark, sf_dir))


# ---- operators shared by the above ----


@query("running_total")
def running_total(spark, sf_dir):
    """Characters written before each document of its source."""
    documents = ex.table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return distributed.running_total(documents, ["doc_id"], F.col("n_chars"), "chars_before", ["source"])
