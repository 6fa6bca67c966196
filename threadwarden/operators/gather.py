"""Selecting posts and comments by community, term, author and recency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.functions.clean import recent
from threadwarden.functions.text import is_symbols, matched_terms, post_text, term_words, text_words
from threadwarden.operators.distributed import ranked_top_n, top_n_per_group
from threadwarden.sources.staging import stage

# Posts asked for per draw, and the sort names each listing accepts.
POSTS_PER_DRAW = 40
SUBREDDIT_SORTS = ("hot", "new", "top", "rising")
SEARCH_SORTS = ("relevance", "hot", "top", "new", "comments")
USER_SORTS = ("new", "hot", "top", "controversial")
# Sorts that the tables themselves define; the others rank by a column the caller names.
SORT_COLUMNS = {"new": "created", "top": "score"}

# Terms up to this number are matched inside each row; more are matched by a join.
MAX_INLINE_TERMS = 2_000
# Draws, and the (id, draw, query) rows chosen by them, are broadcast up to this number, which
# is counted first (the requested totals bound the chosen rows); more are joined by shuffle.
MAX_BROADCAST_HITS = 200_000


def sort_order(sort_by: str, allowed: Sequence[str], sort_col: str | None = None) -> list[Column]:
    """Descending order of a named sort, made total by id."""
    if sort_by not in allowed:
        raise ValueError(f"Invalid sort_by value {sort_by!r}. Use one of {list(allowed)}.")
    column = sort_col or SORT_COLUMNS.get(sort_by)
    if column is None:
        raise ValueError(f"sort_by {sort_by!r} is ranked by the forum's server: name a sort_col to rank by")
    return [F.col(column).desc_nulls_last(), F.col("id")]


def subreddit_posts(
    posts: DataFrame,
    subreddit: str,
    now: float,
    num_posts: int = 10,
    sort_by: str = "new",
    days_back: float | None = 9999,
    sort_col: str | None = None,
) -> DataFrame:
    """First ``num_posts`` posts of a community, then those recent enough (so maybe fewer)."""
    order = sort_order(sort_by, SUBREDDIT_SORTS, sort_col)
    listed = posts.filter(F.col("subreddit") == subreddit).orderBy(*order).limit(num_posts)
    return listed.filter(recent(F.col("created"), days_back, now))


def with_matches(posts: DataFrame, terms: Sequence[str], into: str = "terms") -> DataFrame:
    """Posts with the terms found in title and text."""
    return posts.withColumn(into, matched_terms(post_text(F.col("title"), F.col("selftext")), terms))


def term_matches(df: DataFrame, text: Column, terms: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Distinct (keys, term) of every term (column ``term``) found in a text of these keys.

    A list of ordinary length is held in the plan and each text is scanned where it lies.
    A longer one is joined by word, which needs a shuffle but holds no list anywhere.
    """
    listed = [r.term for r in terms.select("term").distinct().orderBy("term").limit(MAX_INLINE_TERMS + 1).collect()]
    if len(listed) <= MAX_INLINE_TERMS:
        return df.select(*keys, F.explode(matched_terms(text, listed)).alias("term")).distinct()
    return term_matches_by_join(df, text, terms, keys)


def term_matches_by_join(df: DataFrame, text: Column, terms: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """``term_matches`` for term lists of any length: all words of a term must be met.

    Common words are hot keys of the text side; adaptive execution splits them.
    """
    wanted = terms.select("term").distinct().select("term", term_words(F.col("term")).alias("words"))
    # stored, so that the join knows its size: a short list goes to every task and no text word is shuffled
    wanted = stage(wanted.select("term", F.size("words").alias("n_words"), F.explode("words").alias("word")), "wanted")
    symbols = wanted.filter(is_symbols(F.col("word"))).select(F.length("word").alias("n")).distinct().collect()
    words = text_words(text, sorted(r.n for r in symbols))
    # rows that share their keys are texts of their own; words of no term are gone before anything is grouped
    occurring = df.select(*keys, F.xxhash64(text).alias("_text"), F.explode(words).alias("word"))
    return (
        occurring.join(wanted, "word")
        .groupBy(*keys, "_text", "term", "n_words")
        .agg(F.count_distinct("word").alias("n_met"))
        .filter(F.col("n_met") == F.col("n_words"))
        .select(*keys, "term")
        .distinct()
    )


def search_posts(
    posts: DataFrame, query: str, num_posts: int = 10, sort_by: str = "new", sort_col: str | None = None
) -> DataFrame:
    """First ``num_posts`` posts anywhere that contain every word of ``query``."""
    order = sort_order(sort_by, SEARCH_SORTS, sort_col)
    return posts.filter(_contains(query)).orderBy(*order).limit(num_posts)


def search_subreddit_posts(
    posts: DataFrame,
    subreddit: str,
    query: str,
    now: float,
    num_posts: int = 10,
    days_back: float | None = 9999,
    sort_by: str = "new",
    save_query: bool = False,
    sort_col: str | None = None,
) -> DataFrame:
    """Search within a community: limit first, then recency; the query is kept on request."""
    found = search_posts(posts.filter(F.col("subreddit") == subreddit), query, num_posts, sort_by, sort_col)
    stamp = F.lit(query if save_query else None).cast("string")
    return found.filter(recent(F.col("created"), days_back, now)).withColumn("query", stamp)


def _contains(query: str) -> Column:
    if not query.strip():
        return F.lit(True)
    return F.size(matched_terms(post_text(F.col("title"), F.col("selftext")), [query])) > 0


def plan_draws(subreddits: DataFrame, num_posts: int, per_draw: int = POSTS_PER_DRAW) -> DataFrame:
    """Draws per community until ``num_posts`` are requested: (subreddit, draw, requested)."""
    if num_posts <= 0:
        return subreddits.select("subreddit", F.lit(0).alias("draw"), F.lit(0).alias("requested")).limit(0)
    last = -(-num_posts // per_draw) - 1
    return subreddits.select("subreddit", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("draw")).withColumn(
        "requested", F.least(F.lit(per_draw), F.lit(num_posts) - F.lit(per_draw) * F.col("draw"))
    )


def assign_terms(draws: DataFrame, terms: DataFrame, seed: int = 0, pick: Column | None = None) -> DataFrame:
    """One search term per draw, with replacement.

    The pick is a hash of community, draw and seed, so a rerun repeats it; ``pick`` may
    give another whole number per draw. ``terms`` has columns term_no (from 0) and term.
    """
    chosen = F.xxhash64("subreddit", "draw", F.lit(seed)) if pick is None else pick
    counted = terms.agg(F.count(F.lit(1)).alias("n_terms"))
    return (
        draws.crossJoin(F.broadcast(counted))  # one row
        .withColumn("term_no", F.pmod(chosen, F.col("n_terms")).cast("int"))
        .join(terms, "term_no")
        .select(*draws.columns, F.col("term").alias("query"))
    )


def gather(
    posts: DataFrame,
    draws: DataFrame,
    now: float,
    days_back: float | None = None,
    order: Sequence[Column] | None = None,
) -> DataFrame:
    """All draws as one job: the newest matching posts of each (subreddit, draw), stamped.

    ``draws`` has subreddit, draw, requested and query; post ids are unique. The limit of a
    draw applies before recency, as for a single search. A post found by two draws appears
    twice. Only ids and sort keys are ranked; texts are fetched for the chosen posts.
    """
    asked = draws.agg(
        F.max("requested").alias("most"), F.sum("requested").alias("total"), F.count(F.lit(1)).alias("n_draws")
    ).first()
    ranking = ["created"] if order is None else [c for c in posts.columns if c not in ("id", "subreddit", "title", "selftext")]
    order = list(order or sort_order("new", SEARCH_SORTS))
    terms = draws.select(F.col("query").alias("term"))
    # texts of communities that no draw asks for are not read into words
    drawn = draws.select("subreddit").distinct()
    text = post_text(F.col("title"), F.col("selftext"))
    matches = term_matches(posts.join(drawn, "subreddit", "left_semi"), text, terms, ["id", "subreddit", *ranking])
    if asked.n_draws <= MAX_BROADCAST_HITS:
        draws = F.broadcast(draws)
    candidates = matches.withColumnRenamed("term", "query").join(draws, ["subreddit", "query"])
    chosen = (
        ranked_top_n(candidates, ["subreddit", "draw"], order, asked.most or 0, "_rank")
        .filter(F.col("_rank") <= F.col("requested"))
        .filter(recent(F.col("created"), days_back, now))
        .select("id", "draw", "query")
    )
    if (asked.total or 0) <= MAX_BROADCAST_HITS:
        chosen = F.broadcast(chosen)
    return posts.drop("query").join(chosen, "id")


def stamp_comments(comments: DataFrame, stamped_posts: DataFrame, post_key: str = "post_id") -> DataFrame:
    """Comments with the term that found their post (one row per finding draw)."""
    found = stamped_posts.select(F.col("id").alias(post_key), "query").distinct()
    return comments.drop("query").join(found, post_key)


def dedup_hits(hits: DataFrame, key: str = "id") -> DataFrame:
    """One row per post, the first by creation and term, with all terms that found it.

    The terms come from the search list, so the set per post is bounded by that list.
    """
    rest = [c for c in hits.columns if c != key]
    rank = [c for c in ("created", "query", "draw") if c in hits.columns]
    return (
        hits.groupBy(key)
        .agg(
            F.min_by(F.struct(*rest), F.struct(*rank)).alias("first"),
            F.sort_array(F.collect_set("query")).alias("queries"),
        )
        .select(key, "first.*", "queries")
    )


def gather_progress(draws: DataFrame, hits: DataFrame, comments: DataFrame) -> DataFrame:
    """Per community: posts requested, posts and comments saved."""
    asked = draws.groupBy("subreddit").agg(F.sum("requested").alias("requested"))
    saved = hits.groupBy("subreddit").agg(F.count(F.lit(1)).alias("posts_saved"))
    replies = comments.groupBy("subreddit").agg(F.count(F.lit(1)).alias("comments_saved"))
    return (
        asked.join(saved, "subreddit", "left")
        .join(replies, "subreddit", "left")
        .na.fill(0, ["posts_saved", "comments_saved"])
    )


def user_lookup(items: DataFrame, username: str) -> DataFrame:
    """The user as one row, or no row for an unknown name."""
    return items.filter(F.col("author") == username).select(F.col("author").alias("username")).limit(1)


def user_items(
    items: DataFrame,
    user: str,
    now: float,
    num_items: int = 10,
    sort_by: str = "new",
    days_back: float | None = None,
    sort_col: str | None = None,
) -> DataFrame:
    """First ``num_items`` posts or comments of a user, then those recent enough."""
    order = sort_order(sort_by, USER_SORTS, sort_col)
    listed = items.filter(F.col("author") == user).orderBy(*order).limit(num_items)
    return listed.filter(recent(F.col("created"), days_back, now))


def all_user_items(
    items: DataFrame,
    now: float,
    num_items: int = 10,
    sort_by: str = "new",
    days_back: float | None = None,
    sort_col: str | None = None,
    users: DataFrame | None = None,
) -> DataFrame:
    """``user_items`` for every author, or for those in ``users`` (column ``author``), in one job."""
    order = sort_order(sort_by, USER_SORTS, sort_col)
    if users is not None:
        items = items.join(users.select("author").distinct(), "author", "left_semi")
    chosen = top_n_per_group(items.filter(F.col("author").isNotNull()), ["author"], order, num_items)
    return chosen.filter(recent(F.col("created"), days_back, now))
