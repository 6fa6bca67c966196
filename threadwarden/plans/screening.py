"""The whole chain: gather, compose, score, rank, judge.

Each step is a DataFrame-to-DataFrame operator of its own. The stages here save their
tables below one folder, so that each can run by itself, a stopped run goes on where it
ended, and no model is called twice for one conversation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwarden import schemas
from threadwarden.functions.text import CONTEXT_LIMIT, JUDGE_LIMIT
from threadwarden.operators import assess, gather, rank, threads
from threadwarden.sources import ledger, tables

# Stage names, posts requested per community, communities' recency in days.
STAGES = ("gather", "process", "score", "rank", "judge")
NUM_POSTS = 200
DAYS_BACK = 99999
# Columns of a post that its conversation keeps.
PASSED_ON = ("subreddit", "created", "query")


class Screening:
    """A screening run whose tables lie below ``folder``.

    ``posts`` and ``comments`` are the archive to screen. Tables: posts, comments (after
    gathering), conversations, toxicity_calls, scores, ranked, verdict_calls, verdicts.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        toxicity: assess.ScorerFactory | None = None,
        judge: assess.ScorerFactory | None = None,
        attributes: Sequence[str] = schemas.ATTRIBUTES,
        context_size: int = CONTEXT_LIMIT,
        judge_context_size: int = JUDGE_LIMIT,
        response_items: str | None = None,
        verdict_col: str = "is_flagged",
        refresh: bool = False,
        **call_options,
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.toxicity = toxicity
        self.judge = judge
        self.attributes = list(attributes)
        if max(context_size, judge_context_size) > threads.PART_CHARS:
            raise ValueError(f"models read the first part of a conversation: at most {threads.PART_CHARS} characters")
        self.context_size = context_size
        self.judge_context_size = judge_context_size
        self.response_items = response_items
        self.verdict_col = verdict_col
        self.refresh = refresh
        self.call_options = call_options

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def table(self, name: str) -> DataFrame:
        if ledger.commits(self.spark, self.path(name)):
            return ledger.read_commits(self.spark, self.path(name))
        return tables.first_existing(self.spark, self.path(name))

    def gather(
        self,
        posts: DataFrame,
        comments: DataFrame,
        config: DataFrame,
        now: float,
        num_posts: int = NUM_POSTS,
        days_back: float | None = DAYS_BACK,
        seed: int = 0,
        pick: Column | None = None,
    ) -> DataFrame:
        """Search the archive for the config's terms; save found posts and their comments.

        Returns the progress table.
        """
        draws = gather.assign_terms(
            gather.plan_draws(tables.config_subreddits(config), num_posts), tables.config_terms(config), seed, pick
        )
        hits = tables.materialize(
            self.spark, self.path("hits"), lambda: gather.gather(posts, draws, now, days_back), self.refresh
        )
        found = tables.materialize(self.spark, self.path("posts"), lambda: gather.dedup_hits(hits), self.refresh)

        def replies() -> DataFrame:
            members = threads.comments_of_posts(threads.reach_comments(found, comments), found, comments, now, days_back)
            term = found.select(F.col("id").alias("post_id"), "query", "subreddit")
            return members.drop("query", "subreddit").join(term, "post_id").drop("depth")

        stamped = tables.materialize(self.spark, self.path("comments"), replies, self.refresh)
        return gather.gather_progress(draws, hits, stamped)

    def process(self, posts: DataFrame | None = None, comments: DataFrame | None = None) -> DataFrame:
        """Rebuild the conversations of the given posts, or of the gathered ones."""

        def rebuilt() -> DataFrame:
            known = self.table("posts") if posts is None else posts
            keep = [c for c in PASSED_ON if c in known.columns]
            return threads.compose(known, self.table("comments") if comments is None else comments, keep=keep)

        return tables.materialize(self.spark, self.path("conversations"), rebuilt, self.refresh)

    def score(self, start_row: int = 0, retry_failed: bool = False) -> DataFrame:
        """Send the conversations not yet scored to the classifier; save the wide scores.

        A model reads the beginning of a conversation only, which lies in its first part.
        """
        items = assess.prepare(self._first_parts(start_row), context_size=self.context_size)
        path = self.path("toxicity_calls")
        assess.continue_calls(items, path, self.toxicity, retry_failed=retry_failed, **self.call_options)

        def parsed(calls: DataFrame) -> DataFrame:
            return assess.flatten_scores(assess.parse_responses(calls), self.attributes)

        return assess.parse_new_calls(self.spark, path, self.path("scores"), parsed)

    def _first_parts(self, start_row: int) -> DataFrame:
        first = self.table("conversations").filter(F.col("part") == 0)
        if not start_row:
            return first
        later = assess.batch_slices(first.select("post_id"), ["post_id"], start_row=start_row).select("post_id")
        return first.join(later, "post_id", "left_semi")

    def rank(self, required_attributes: Sequence[str] | None = None, k: int | None = None) -> DataFrame:
        """Scored conversations by their worst attribute; ``k`` keeps the worst.

        The table is saved unsorted, so that its texts are sorted only for who reads them all.
        """
        maxima = rank.with_worst_attribute(self.table("scores"), self.attributes)
        maxima = rank.keep_attributes(maxima.select("post_id", "max_score", "max_attribute"), required_attributes)
        listed = maxima if k is None else rank.shortlist(maxima, k)
        scored = rank.with_scores(self.table("conversations"), listed)
        return rank.worst_first(tables.materialize(self.spark, self.path("ranked"), lambda: scored, refresh=True))

    def ask(self, k: int | None = None, start_row: int = 0, retry_failed: bool = False) -> DataFrame:
        """Send ranked conversations, else all, to the language model; save the verdicts."""
        source = tables.first_existing(self.spark, self.path("ranked"), self.path("conversations"))
        source = source.filter(F.col("part") == 0)
        ranked = "max_score" in source.columns
        order = [*([F.col("max_score").desc_nulls_last()] if ranked else []), F.col("post_id")]
        narrow = source.select("post_id", *(["max_score"] if ranked else []))
        if ranked and k is not None:
            narrow = rank.shortlist(narrow, k)
        if start_row:
            narrow = assess.batch_slices(narrow, order, start_row=start_row).drop("position", "batch")
        # texts are joined to the ids that were chosen
        texts = assess.prepare_prompts(source, context_size=self.judge_context_size)
        path = self.path("verdict_calls")
        assess.continue_calls(
            texts.join(narrow, "post_id"),
            path,
            self.judge,
            send="prompt",
            retry_failed=retry_failed,
            order=order,
            **self.call_options,
        )

        def parsed(calls: DataFrame) -> DataFrame:
            return assess.parse_verdicts(calls, self.verdict_col, response_items=self.response_items)

        return assess.parse_new_calls(self.spark, path, self.path("verdicts"), parsed)

    def errors(self) -> DataFrame:
        """Failed calls and unreadable responses of both models so far, with their stage."""
        scoring = assess.parse_responses(self.table("toxicity_calls"))
        found = assess.error_rows(scoring).unionByName(assess.parse_error_rows(scoring)).withColumn("stage", F.lit("score"))
        if ledger.commits(self.spark, self.path("verdict_calls")):
            judging = self.table("verdict_calls")
            judged = assess.error_rows(judging).unionByName(
                assess.verdict_error_rows(judging, self.verdict_col, self.response_items)
            )
            found = found.unionByName(judged.withColumn("stage", F.lit("judge")))
        return found

    def totals(self) -> DataFrame:
        return assess.run_totals(self.table("verdict_calls"))

    def run(self, stages: Sequence[str] = STAGES[1:], **archive) -> None:
        """Run some stages in order; ``archive`` goes to gather, or gives posts and comments."""
        unknown = [s for s in stages if s not in STAGES]
        if unknown:
            raise ValueError(f"Unknown stages: {unknown}. Use some of {list(STAGES)}.")
        steps = {
            "gather": lambda: self.gather(**archive),
            "process": lambda: self.process() if "gather" in stages else self.process(**archive),
            "score": self.score,
            "rank": self.rank,
            "judge": self.ask,
        }
        for name in STAGES:
            if name in stages:
                steps[name]()
