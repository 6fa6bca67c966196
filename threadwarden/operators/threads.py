"""Reply trees and their conversation texts.

``link_comments`` finds, for every comment, its post, its depth and the size of what is below
it by pointer doubling: each round every unfinished comment takes over what its current
ancestor knows, and an ancestor adds up what those that point at it know, so a tree of depth
d needs about log2(d) rounds over rows of fixed width. ``place_lines`` adds up sizes along each
path to the line's character offset in the conversation, which is also its place in reading
order. ``compose`` then fetches the texts once and joins them up in bounded parts, so that one
giant thread is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadwarden.functions.clean import (
    fill_comments,
    fill_posts,
    parent_key,
    parent_kind,
    recent,
    require_columns,
)
from threadwarden.operators.distributed import keep_first, running_total
from threadwarden.sources.staging import read_stages, stage, write_stage

POST_COLUMNS = ("id", "title", "selftext", "author")
COMMENT_COLUMNS = ("id", "body", "parent_id", "author")

# The text layout of a conversation.
POST_LINES = ("Post ID: ", "Post Title: ", "Post Content: ", "Post Author: ")
POST_RULE = "-" * 50
REPLY_LINE = "This comment is a reply to parent comment: "
COMMENT_LINES = ("Comment ID: ", "Comment Author: ", "Comment Body: ")
COMMENT_RULE = "-" * 30
INDENT = "  "
NO_COMMENTS = "No comments\n"

# Threads longer than this are delivered as several rows, in order of ``part``.
PART_CHARS = 4_000_000


def decode_parents(comments: DataFrame) -> DataFrame:
    """``parent_kind`` (post, comment or null) and ``parent_key`` from the prefixed parent id."""
    return comments.withColumns({
        "parent_kind": parent_kind(F.col("parent_id")),
        "parent_key": parent_key(F.col("parent_id")),
    })


def top_level_comments(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments that answer a known post directly."""
    direct = decode_parents(comments).filter(F.col("parent_kind") == "post").withColumnRenamed("parent_key", "post_id")
    known = posts.select(F.col("id").alias("post_id")).distinct()
    return direct.drop("parent_kind").join(known, "post_id", "left_semi")


def post_header(post_id: Column, title: Column, selftext: Column, author: Column) -> Column:
    parts = [p for label, value in zip(POST_LINES, (post_id, title, selftext, author)) for p in (F.lit(label), value, F.lit("\n"))]
    return F.concat(*parts, F.lit(POST_RULE + "\n"))


def comment_lines(comment_id: Column, author: Column, body: Column, depth: Column, parent: Column) -> Column:
    """The lines of one comment; only line starts are indented, not line breaks inside a body."""
    indent = F.repeat(F.lit(INDENT), depth)
    reply = F.when(parent.isNotNull(), F.concat(indent, F.lit(REPLY_LINE), parent, F.lit("\n"))).otherwise("")
    id_label, author_label, body_label = (F.lit(label) for label in COMMENT_LINES)
    return F.concat(
        *[indent, id_label, comment_id, F.lit("\n"), reply],
        *[indent, author_label, author, F.lit("\n")],
        *[indent, body_label, body, F.lit("\n")],
        *[indent, F.lit(COMMENT_RULE + "\n")],
    )


def _order_columns(df: DataFrame, order: Sequence[str] | None) -> list[str]:
    if order is not None:
        return list(order)
    return ["ord"] if "ord" in df.columns else [c for c in ("created", "id") if c in df.columns]


def _sort_text(order: Sequence[str], df: DataFrame) -> Column:
    """The sibling order as text that sorts the same way bytewise, null last.

    Whole numbers and times (in microseconds) become 16 hex digits; other numbers keep six
    decimals.
    """
    parts = []
    for name in order:
        kind = dict(df.dtypes)[name]
        if kind == "string":
            shown = F.concat(F.col(name), F.lit("\u0001"))
        elif kind in ("tinyint", "smallint", "int", "bigint", "date") or kind.startswith("timestamp"):
            number = F.col(name)
            if kind == "date":
                number = F.unix_date(number)
            elif kind.startswith("timestamp"):
                number = F.unix_micros(number.cast("timestamp"))
            # flipping the sign bit makes negatives sort first
            shown = F.lpad(F.hex(number.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
        else:
            # moved above zero, so that the digits sort as the numbers do
            moved = F.col(name).try_cast("decimal(31,6)") + F.lit("1" + "0" * 24).cast("decimal(31,6)")
            shown = F.lpad(moved.cast("string"), 33, "0")
        parts.append(F.coalesce(F.concat(F.lit("0"), shown), F.lit("1")))
    return F.concat(*parts)


def link_comments(
    comments: DataFrame,
    order: Sequence[str] | None = None,
    duplicates: str = "first",
    sizes: bool = False,
) -> DataFrame:
    """Every comment whose ancestors end at a post id.

    Columns: id, post_id, parent_comment_id, depth, sibling (sorts the replies to one parent),
    the lengths of author and body, and copy. ``order`` names the columns that order siblings:
    ``ord`` if present, else creation time. ``duplicates`` is "first" (one row per id), "none"
    (ids are known to be unique) or "repeat" (each row copy is visited, so copies multiply
    along a path; a path that would meet an id again is left out).

    With ``sizes`` each comment also knows what stands below it: how many comments, lines and
    characters, the latter as if the comment itself were at depth 0; and its layer (see ``_peel``).
    """
    if duplicates not in ("first", "none", "repeat"):
        raise ValueError(f"Invalid duplicates value: {duplicates}")
    require_columns(comments, COMMENT_COLUMNS, "comments")
    repeat = duplicates == "repeat"
    order = _order_columns(comments, order)
    filled = fill_comments(comments)
    narrow = filled.filter(F.col("id").isNotNull()).select(
        "id",
        "parent_id",
        _sort_text(order, comments).alias("sibling"),
        F.length("author").alias("author_chars"),
        F.length("body").alias("body_chars"),
        _content(comments).alias("content"),
    )
    if duplicates == "first":
        # texts and sort keys only meet an aggregate if some id is repeated
        if _any_repeated(narrow, ["id"]):
            narrow = keep_first(narrow, ["id"], ["sibling", "content"])
    elif repeat:
        # the first copy's text stands for the id, wherever a copy of it is shown
        shown = ["author_chars", "body_chars", "content"]
        first = keep_first(narrow.select("id", "sibling", *shown), ["id"], ["sibling", "content"]).drop("sibling")
        narrow = narrow.drop(*shown).join(first, "id")
    kind, key = parent_kind(F.col("parent_id")), parent_key(F.col("parent_id"))
    placed = narrow.filter(kind.isNotNull()).select(
        "id",
        F.when(kind == "post", key).alias("post_id"),
        F.when(kind == "comment", key).alias("parent_comment_id"),
        "sibling",
        "author_chars",
        "body_chars",
        "content",
        # tells identical copies apart; frozen by the stage table
        (F.monotonically_increasing_id() if repeat else F.lit(0).cast("long")).alias("copy"),
    )
    nodes = placed.withColumns({"chars": _own_chars(), "lines": _own_lines()})
    path, seen = write_stage(nodes, "nodes", n=F.count(F.lit(1)))
    nodes = read_stages(nodes, path)
    if not repeat and seen["n"] > PEEL_ROWS:
        core, layers = _peel(nodes)
        return nodes.drop("post_id", *([] if sizes else ["chars", "lines"])).join(_linked_layers(core, layers, sizes), "id")
    finished, unfinished = _ascend(nodes, repeat, sizes)
    places = finished.select("id", "parent_comment_id", "post_id", "depth")
    if repeat:
        on = (F.col("id") == F.col("_id")) & F.col("parent_comment_id").eqNullSafe(F.col("_parent"))
        places = places.distinct().withColumnsRenamed({"id": "_id", "parent_comment_id": "_parent"})
        tree = nodes.drop("post_id").join(places, on).drop("_id", "_parent")
    else:
        tree = nodes.drop("post_id").join(places.drop("parent_comment_id"), "id")
    if not sizes:
        return tree.drop("chars", "lines")
    below = _sums(unfinished).groupBy("id").agg(*[F.sum(c).alias(c) for c in _BELOW])
    return tree.join(below, "id", "left").withColumns({**{c: F.coalesce(c, F.lit(0)) for c in _BELOW}, "layer": F.lit(0)})


# What stands below a comment: characters as if it were at depth 0, lines, comments.
_BELOW = ("chars_below", "lines_below", "comments_below")


def _own_chars() -> Column:
    """Length of the comment's lines at depth 0."""
    marks = F.lit("")
    bare = F.length(comment_lines(F.col("id"), marks, marks, F.lit(0), F.col("parent_comment_id")))
    return (bare + F.col("author_chars") + F.col("body_chars")).cast("long")


def _own_lines() -> Column:
    return F.when(F.col("parent_comment_id").isNull(), len(COMMENT_LINES) + 1).otherwise(len(COMMENT_LINES) + 2).cast("long")


# Tables of more comments lose their leaves, layer by layer, before pointers are doubled.
PEEL_ROWS = 100_000


def _peel(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(what is left, the layers taken off): comments nothing is left below, as long as they are a quarter.

    A layer hands what stands below it and its own size to its parents, and knows the same of
    itself for good; it is linked again from its parents. Tables shrink by a quarter at least,
    so all layers together cost a few passes, where each doubling would carry every row.
    Chains have few leaves and are left to the doubling, as is what is left here.
    """
    parent = F.col("parent_comment_id")
    children = nodes.filter(parent.isNotNull()).groupBy(parent.alias("id")).agg(F.count(F.lit(1)).alias("children"))
    own = nodes.select("id", "parent_comment_id", "post_id", "chars", "lines").join(children, "id", "left")
    rows = own.withColumns({"children": F.coalesce("children", F.lit(0)), **{c: F.lit(0).cast("long") for c in _BELOW}})
    leaf = (F.col("children") == 0) & parent.isNotNull()
    measures = {"n": F.count(F.lit(1)), "leaves": F.count(F.when(leaf, 1))}
    path, seen = write_stage(rows, "peeled", **measures)
    left, layers = read_stages(rows, path), []
    while seen["n"] > PEEL_ROWS and 4 * seen["leaves"] >= seen["n"]:
        layer = left.filter(leaf)
        layers.append(layer.drop("children"))
        handed = layer.withColumns({"ancestor": parent, "depth": F.lit(1), "copies": F.lit(1)})
        more = _sums(handed, F.count(F.lit(1)).alias("gone")).withColumnsRenamed({c: f"more_{c}" for c in _BELOW})
        added = {c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in _BELOW}
        rest = left.filter(~leaf).join(more, "id", "left")
        rest = rest.withColumns({**added, "children": F.col("children") - F.coalesce("gone", F.lit(0))})
        path, seen = write_stage(rest.select(*rows.columns), "peeled", **measures)
        left = read_stages(rows, path)
    return left.drop("children"), layers


def _linked_layers(core: DataFrame, layers: list[DataFrame], sizes: bool) -> DataFrame:
    """Post and depth of the linked comments of a peeled table; with ``sizes``, what is below them and the layer."""
    finished, unfinished = _ascend(core, False, sizes)
    places = finished.select("id", "post_id", "depth")
    if sizes:
        more = _sums(unfinished).withColumnsRenamed({c: f"more_{c}" for c in _BELOW})
        below = core.select("id", *_BELOW).join(more, "id", "left")
        below = below.select("id", *[(F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in _BELOW])
        places = places.join(below, "id").withColumn("layer", F.lit(0))
    path, _ = write_stage(places, "places")
    paths = [path]
    for number in range(len(layers), 0, -1):
        above = read_stages(places, *paths).select(F.col("id").alias("parent_comment_id"), "post_id", (F.col("depth") + 1).alias("depth"))
        linked = layers[number - 1].drop("post_id").join(above, "parent_comment_id")
        path, _ = write_stage(linked.withColumn("layer", F.lit(number)).select(*places.columns), "places")
        paths.append(path)
    return read_stages(places, *paths)


def _ascend(nodes: DataFrame, repeat: bool, sizes: bool) -> tuple[DataFrame, DataFrame]:
    """Pointer doubling towards the posts: (linked rows, all unfinished rows of all rounds).

    In round k an unfinished row points to the ancestor 2**k levels up and, with ``sizes``,
    carries the sums over the descendants less than 2**k levels down. The descendants of the
    next 2**k levels are those whose rows point at it, so one aggregate by ancestor doubles
    the reach downwards as one join by ancestor doubles it upwards. Rows have a fixed width.
    Copies under one parent are one row with their number; numbers multiply along a path.
    """
    keys = ["id", "parent_comment_id", "post_id"]
    peeled = [c for c in _BELOW if sizes and c in nodes.columns]
    own = nodes.select(*keys, "chars", "lines", *peeled)
    if repeat:
        # a path that meets an id again meets one that has several parents: only those are remembered
        parents = F.struct(F.col("parent_comment_id").isNull().alias("top"), F.coalesce("parent_comment_id", "post_id").alias("key"))
        several = nodes.groupBy("id").agg((F.min(parents) != F.max(parents)).alias("several"))
        edges = own.groupBy(*keys).agg(F.first("chars").alias("chars"), F.first("lines").alias("lines"), F.count(F.lit(1)).alias("copies"))
        edges = edges.join(several, "id").withColumn("met", F.when(F.col("several"), F.array("id")).otherwise(F.array().cast("array<string>")))
    else:
        edges = own.withColumn("copies", F.lit(1).cast("long"))
    extra = ["met"] if repeat else []
    # what was peeled off counts as part of the comment it hung on
    below = {c: F.lit(0).cast("long") for c in _BELOW if c not in peeled} if sizes else {}
    start = edges.withColumns({"ancestor": F.col("parent_comment_id"), "depth": F.when(F.col("post_id").isNull(), 1).otherwise(0), **below})
    sums = ["chars", "lines", *_BELOW] if sizes else []
    start = start.select("id", "parent_comment_id", "ancestor", "post_id", "depth", "copies", *sums, *extra)
    measures = {"waiting": F.count("ancestor"), "done": F.count("post_id")}
    path, seen = write_stage(start, "links", **measures)
    paths = [path]
    while seen["waiting"] and (len(paths) == 1 or seen["done"]):
        # a round in which nothing finishes is the last: the rest hangs on cycles
        open_rows = read_stages(start, paths[-1]).filter(F.col("ancestor").isNotNull())
        known = read_stages(start, *paths).filter(F.col("post_id").isNotNull()).unionByName(open_rows)
        known = known.select(
            F.col("id").alias("ancestor"),
            F.col("ancestor").alias("next_ancestor"),
            F.col("post_id").alias("known_post"),
            F.col("depth").alias("steps"),
            F.col("copies").alias("upper_copies"),
            *([F.col("met").alias("upper_met")] if repeat else []),
        )
        joined = open_rows.drop("post_id").join(known, "ancestor")
        if repeat:
            joined = joined.filter(~F.arrays_overlap("met", "upper_met"))
        step = joined.select(
            "id",
            "parent_comment_id",
            F.col("next_ancestor").alias("ancestor"),
            F.col("known_post").alias("post_id"),
            (F.col("depth") + F.col("steps")).alias("depth"),
            # an overflow can only happen on a cycle, whose rows never finish
            F.try_multiply("copies", "upper_copies").alias("copies") if repeat else F.col("copies"),
            *sums,
            *([F.concat("upper_met", "met").alias("met")] if repeat else []),
        )
        if sizes:
            more = _sums(open_rows).withColumnsRenamed({c: f"more_{c}" for c in _BELOW})
            step = step.join(more, "id", "left").withColumns({c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0)) for c in _BELOW})
        path, seen = write_stage(step.select(*start.columns), "links", **measures)
        paths.append(path)
    rows = read_stages(start, *paths)
    return rows.filter(F.col("post_id").isNotNull()), rows.filter(F.col("ancestor").isNotNull())


def _sums(unfinished: DataFrame, *others: Column) -> DataFrame:
    """What unfinished rows add to the ancestor that they point to, per ancestor as ``id``."""
    lines = F.col("lines") + F.col("lines_below")
    chars = F.col("chars") + F.col("chars_below") + len(INDENT) * F.col("depth") * lines
    adds = {"chars_below": chars, "lines_below": lines, "comments_below": 1 + F.col("comments_below")}
    added = [F.try_sum(F.try_multiply("copies", value)).alias(name) for name, value in adds.items()]
    return unfinished.groupBy(F.col("ancestor").alias("id")).agg(*added, *others)


def place_lines(
    posts: DataFrame,
    tree: DataFrame,
    order: Sequence[str] | None = None,
    max_chars: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Post headers and linked comments with their character offset in the conversation.

    ``tree`` is made by ``link_comments`` with ``sizes``. A comment stands behind its parent and
    what is below its earlier siblings, so its offset is a sum along its path, found by pointer
    doubling. With ``max_chars`` only lines that begin before that offset are followed: a
    partial sum that reaches it ends a path. Comments of unknown posts are dropped.

    Columns: post_id, id (null for the header), parent_comment_id, depth, offset, content,
    n_comments, copies (post rows with this id), kept (the columns ``keep`` of the post, if named).
    """
    require_columns(posts, POST_COLUMNS, "posts")
    filled = fill_posts(posts).filter(F.col("id").isNotNull())
    header = post_header(F.col("id"), F.col("title"), F.col("selftext"), F.col("author"))
    ranked = _order_columns(posts, order)
    rank = F.struct(_sort_text(ranked, posts) if ranked else F.lit(""), _content(posts))
    columns = ["id", "post_id", "parent_comment_id", "sibling", "copy", "content", "chars", "lines", *_BELOW, "layer"]
    rows = tree.select(*columns)
    path, seen = write_stage(rows, "siblings", copies=F.max("copy"))
    rows = read_stages(rows, path)
    # only if row copies are visited do rows have a number of their own
    repeat = (seen["copies"] or 0) > 0
    if repeat:
        # a copy below several places is one row
        rows = stage(rows.withColumn("post_id", F.when(F.col("parent_comment_id").isNull(), F.col("post_id"))).distinct(), "siblings")
    headers = filled.groupBy(F.col("id").alias("post_id")).agg(
        F.min_by(F.length(header), rank).alias("header_chars"),
        F.min_by(_content(posts), rank).alias("header_content"),
        F.count(F.lit(1)).alias("copies"),
        *([F.min_by(F.struct(*keep), rank).alias("kept")] if keep else []),
    )
    kept = ["kept"] if keep else []
    comments_of = rows.filter("parent_comment_id is null").groupBy("post_id").agg(F.sum(1 + F.col("comments_below")).alias("n_comments"))
    headers = headers.join(comments_of, "post_id", "left").withColumn("n_comments", F.coalesce("n_comments", F.lit(0)))
    headers = stage(headers, "headers")
    offsets = _descend(_before_siblings(rows), max_chars, repeat)
    offset = (F.col("header_chars") + F.col("before") + len(INDENT) * F.col("depth") * F.col("before_lines")).alias("offset")
    placed = offsets.join(headers, "post_id").select(
        "post_id", "id", "parent_comment_id", "depth", offset, "content", "n_comments", "copies", *kept
    )
    if max_chars is not None:
        placed = placed.filter(F.col("offset") < max_chars)
    nothing = F.lit(None).cast("string")
    first = headers.select(
        "post_id", nothing.alias("id"), nothing.alias("parent_comment_id"), F.lit(-1).alias("depth"),
        F.lit(0).cast("long").alias("offset"), F.col("header_content").alias("content"), "n_comments", "copies", *kept,
    )
    return first.unionByName(placed)


# Replies to one parent are summed in one window up to this number, more of them slice by slice.
FAMILY_ROWS = 10_000


def _before_siblings(rows: DataFrame) -> DataFrame:
    """``rows`` with ``before`` and ``before_lines``: characters and lines of the earlier siblings and all below them."""
    group = F.coalesce(F.concat(F.lit("c"), "parent_comment_id"), F.concat(F.lit("p"), "post_id"))
    sizes = {"before": F.col("chars") + F.col("chars_below"), "before_lines": F.col("lines") + F.col("lines_below")}
    order = ["sibling", "id", "copy"]
    narrow = rows.withColumn("family", group)
    # counted by a hash: families that share one may be summed in slices too, which is as right
    hashed = F.xxhash64("family").alias("hashed")
    large = stage(narrow.groupBy(hashed).count().filter(F.col("count") > FAMILY_ROWS).select("hashed"), "families")
    earlier = Window.partitionBy("family").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = {name: F.coalesce(F.sum(size).over(earlier), F.lit(0)) for name, size in sizes.items()}
    if large.isEmpty():
        return narrow.withColumns(summed)
    small = narrow.join(large, hashed == F.col("hashed"), "left_anti").withColumns(summed)
    sliced = narrow.join(large, hashed == F.col("hashed"), "left_semi")
    return small.unionByName(
        running_total(sliced, order, list(sizes.values()), list(sizes), within=["family"], null_groups=False)
    )


def _descend(rows: DataFrame, max_chars: int | None, repeat: bool) -> DataFrame:
    """Sums of (before, before_lines) and of the ancestors' own lines along each row's path, with depth and post.

    A sum over a piece of a path is kept as (characters, lines), since each level further
    down indents every line once more: characters count as if the lowest row were at depth 0.
    """
    extra = []
    if repeat:
        parents = F.struct(F.col("parent_comment_id").isNull().alias("top"), F.coalesce("parent_comment_id", "post_id").alias("key"))
        several = rows.groupBy("id").agg((F.min(parents) != F.max(parents)).alias("several"))
        rows = rows.join(several, "id").withColumn("met", F.when(F.col("several"), F.array("id")).otherwise(F.array().cast("array<string>")))
        extra = ["met"]
    top = F.col("parent_comment_id").isNull()
    start = rows.select(
        "id", "parent_comment_id", "content", "chars", "lines", "before", "before_lines",
        F.col("parent_comment_id").alias("ancestor"), F.when(top, F.col("post_id")).alias("post_id"),
        F.when(top, 0).otherwise(1).alias("depth"), "layer", *extra,
    )

    def within_reach(df: DataFrame) -> DataFrame:
        if max_chars is None:
            return df
        return df.filter(F.col("before") + len(INDENT) * F.col("depth") * F.col("before_lines") < max_chars)

    def lengthened(open_rows: DataFrame, known: DataFrame) -> DataFrame:
        """``open_rows`` with what their ancestor knows."""
        known = known.select(
            F.col("id").alias("ancestor"),
            F.col("ancestor").alias("next_ancestor"),
            F.col("post_id").alias("known_post"),
            F.col("depth").alias("steps"),
            # a reply stands behind its parent's own lines too
            (F.col("before") + F.col("chars")).alias("upper"),
            (F.col("before_lines") + F.col("lines")).alias("upper_lines"),
            *([F.col("met").alias("upper_met")] if repeat else []),
        )
        joined = open_rows.drop("post_id").join(known, "ancestor")
        if repeat:
            joined = joined.filter(~F.arrays_overlap("met", "upper_met"))
        raised = F.col("before") + F.col("upper") - len(INDENT) * F.col("depth") * F.col("upper_lines")
        return within_reach(joined.select(
            "id", "parent_comment_id", "content", "chars", "lines",
            raised.alias("before"), (F.col("before_lines") + F.col("upper_lines")).alias("before_lines"),
            F.col("next_ancestor").alias("ancestor"), F.col("known_post").alias("post_id"),
            (F.col("depth") + F.col("steps")).alias("depth"), "layer",
            *([F.concat("upper_met", "met").alias("met")] if repeat else []),
        ))

    def finished(paths: list[str]) -> DataFrame:
        return read_stages(start, *paths).filter(F.col("post_id").isNotNull())

    # layers that were peeled off wait until all that is above them is placed
    waiting = F.col("ancestor").isNotNull() & (F.col("layer") == 0)
    measures = {"waiting": F.count(F.when(waiting, 1)), "done": F.count("post_id")}
    path, seen = write_stage(within_reach(start), "offsets", **measures, layers=F.max("layer"))
    paths, layers = [path], seen["layers"] or 0
    while seen["waiting"] and (len(paths) == 1 or seen["done"]):
        open_rows = read_stages(start, paths[-1]).filter(waiting)
        path, seen = write_stage(lengthened(open_rows, finished(paths).unionByName(open_rows)), "offsets", **measures)
        paths.append(path)
    for number in range(layers, 0, -1):
        layer = read_stages(start, paths[0]).filter(F.col("layer") == number)
        path, _ = write_stage(lengthened(layer, finished(paths)), "offsets")
        paths.append(path)
    return finished(paths).drop("ancestor", "layer", *extra)


def compose(
    posts: DataFrame,
    comments: DataFrame,
    order: Sequence[str] | None = None,
    duplicates: str = "first",
    part_chars: int = PART_CHARS,
    max_chars: int | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One conversation text per post: (post_id, part, full_conversation), and the post's columns ``keep``.

    A thread of up to ``part_chars`` characters is one row with part 0. A longer one comes
    in several rows which, joined in order of ``part``, give the whole text; a part breaks
    only between comments. With ``max_chars`` the result is the exact beginning of each
    text, and only the comments it needs are fetched.
    """
    if duplicates == "first" and not _any_repeated(comments, ["id"]):
        # counted once for the tree and the texts
        duplicates = "none"
    tree = link_comments(comments, order, duplicates, sizes=True)
    return render(posts, comments, place_lines(posts, tree, max_chars=max_chars, keep=keep), order, duplicates, part_chars, max_chars)


def render(
    posts: DataFrame,
    comments: DataFrame,
    placed: DataFrame,
    order: Sequence[str] | None = None,
    duplicates: str = "first",
    part_chars: int = PART_CHARS,
    max_chars: int | None = None,
) -> DataFrame:
    """Conversation texts of lines placed by ``place_lines``."""
    if max_chars is not None:
        part_chars = max(part_chars, max_chars)
        # stored, so that the join below knows how few lines there are
        placed = stage(placed.filter(F.col("offset") < max_chars), "beginnings")
    placed = placed.withColumn("part", F.floor(F.col("offset") / part_chars))
    no_title = F.lit(None).cast("string").alias("title")
    post_texts = _texts(fill_posts(posts), _content(posts), F.lit(True), F.col("title"), F.col("selftext").alias("body"))
    comment_texts = _texts(fill_comments(comments), _content(comments), F.lit(False), no_title, F.col("body"))
    # the line names the copy that stands for its id, so texts meet no aggregate
    comment_texts = comment_texts if duplicates == "none" else _without_repeats(comment_texts)
    texts = _without_repeats(post_texts).unionByName(comment_texts)
    is_post = F.col("depth") < 0
    lines = placed.withColumns({"is_post": is_post, "line_id": F.when(is_post, F.col("post_id")).otherwise(F.col("id"))})
    header = post_header(F.col("line_id"), F.col("title"), F.col("body"), F.col("author"))
    header = F.concat(header, F.when(F.col("n_comments") == 0, NO_COMMENTS).otherwise(""))
    reply = comment_lines(*[F.col(c) for c in ("line_id", "author", "body", "depth", "parent_comment_id")])
    parts = (
        lines.join(texts, ["is_post", "line_id", "content"])
        .withColumn("text", F.when(F.col("is_post"), header).otherwise(reply))
        .groupBy("post_id", "part")
        .agg(
            F.expr("listagg(text, '') within group (order by offset)").alias("full_conversation"),
            F.max("copies").alias("copies"),
            *([F.first("kept").alias("kept")] if "kept" in placed.columns else []),
        )
    )
    if max_chars is not None:
        parts = parts.withColumn("full_conversation", F.substring("full_conversation", 1, max_chars))
    if duplicates == "repeat":
        parts = parts.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return parts.select("post_id", "part", "full_conversation", *(["kept.*"] if "kept" in parts.columns else []))


def _texts(filled: DataFrame, content: Column, is_post: Column, title: Column, body: Column) -> DataFrame:
    return filled.withColumn("content", content).filter(F.col("id").isNotNull()).select(
        is_post.alias("is_post"), F.col("id").alias("line_id"), "author", title, body, "content"
    )


def _without_repeats(texts: DataFrame) -> DataFrame:
    """One row per id and content; texts are only shuffled for it if some row is repeated."""
    keys = ["line_id", "content"]
    return texts.dropDuplicates(keys) if _any_repeated(texts, keys) else texts


def _any_repeated(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether two rows agree in ``keys``; rows with a null key are no rows of a thread."""
    known = df.select(*keys).dropna()
    return not known.groupBy(*keys).count().filter("count > 1").isEmpty()


def _content(df: DataFrame) -> Column:
    return F.xxhash64(*[c for c in ("title", "selftext", "author", "body") if c in df.columns])


def unreached_comments(posts: DataFrame, comments: DataFrame, tree: DataFrame) -> DataFrame:
    """Comments that appear in no conversation: (id, parent_id, reason).

    Their reply chain ends at a post id that is not in ``posts`` (``unknown post``), at a
    comment that is not in ``comments`` (``missing comment``) or whose parent id cannot be read
    (``unreadable parent``), or it never ends (``cycle``). Of rows repeated under one id the
    least parent id is shown, and decides.
    """
    ids = comments.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min("parent_id").alias("parent_id"))
    known = posts.select(F.col("id").alias("post_id")).distinct().withColumn("known", F.lit(True))
    homes = (
        tree.select("id", "post_id")
        .join(known, "post_id", "left")
        .groupBy("id")
        .agg(F.max("known").alias("known"), F.lit(True).alias("linked"))
    )
    gaps = stage(ids.join(homes, "id", "left").filter(F.col("known").isNull()).select("id", "parent_id", "linked"), "gaps")
    unknown = gaps.filter("linked").select("id", "parent_id", F.lit("unknown post").alias("reason"))
    return unknown.unionByName(_broken_chains(gaps.filter("linked is null").select("id", "parent_id")))


def _broken_chains(lost: DataFrame) -> DataFrame:
    """``lost`` (id, parent_id) with the reason for which a chain meets no post.

    All ancestors of a lost comment are lost. Pointers double until no chain ends any more:
    the chains left over lead into a cycle.
    """
    kind, key = parent_kind(F.col("parent_id")), parent_key(F.col("parent_id"))
    ancestors = lost.select(F.col("id").alias("ancestor"), F.lit(True).alias("there"))
    start = (
        lost.select("id", "parent_id", F.when(kind == "comment", key).alias("ancestor"), kind.isNull().alias("unreadable"))
        .join(ancestors, "ancestor", "left")
        .select(
            "id",
            "parent_id",
            F.when(F.col("there"), F.col("ancestor")).alias("ancestor"),
            F.when(F.col("unreadable"), "unreadable parent").when(F.col("there").isNull(), "missing comment").alias("reason"),
        )
    )
    measures = {"waiting": F.count("ancestor"), "done": F.count("reason")}
    path, seen = write_stage(start, "chains", **measures)
    paths = [path]
    while seen["waiting"] and (len(paths) == 1 or seen["done"]):
        open_rows = read_stages(start, paths[-1]).filter(F.col("ancestor").isNotNull())
        known = read_stages(start, *paths).filter(F.col("reason").isNotNull()).unionByName(open_rows)
        known = known.select(F.col("id").alias("ancestor"), F.col("ancestor").alias("next_ancestor"), F.col("reason").alias("known_reason"))
        step = open_rows.drop("reason").join(known, "ancestor").select(
            "id", "parent_id", F.col("next_ancestor").alias("ancestor"), F.col("known_reason").alias("reason")
        )
        path, seen = write_stage(step, "chains", **measures)
        paths.append(path)
    ended = read_stages(start, *paths).filter(F.col("reason").isNotNull()).drop("ancestor")
    endless = read_stages(start, paths[-1]).filter(F.col("ancestor").isNotNull())
    return ended.unionByName(endless.select("id", "parent_id", F.lit("cycle").alias("reason")))


def comments_of_posts(
    tree: DataFrame, chosen: DataFrame, comments: DataFrame, now: float = 0.0, days_back: float | None = None
) -> DataFrame:
    """The comments, at any depth, of the chosen posts (column ``id``), with their post id.

    With ``days_back``, those created not longer than so many days before ``now``.
    """
    comments = comments.filter(recent(F.col("created"), days_back, now)) if days_back is not None else comments
    wanted = chosen.select(F.col("id").alias("post_id")).distinct()
    members = tree.select("id", "post_id", "depth").join(wanted, "post_id", "left_semi")
    return comments.join(members, "id")


# Levels that ``reach_comments`` goes down one by one before it doubles its steps.
LEVELS = 24


def reach_comments(chosen: DataFrame, comments: DataFrame, order: Sequence[str] | None = None, levels: int = LEVELS) -> DataFrame:
    """(id, post_id, depth) of the comments below the chosen posts (column ``id``), at any depth.

    Level by level, the comments that answer the level above are joined to it, until a level
    is empty: the work after the first pass follows the chosen threads. Of the other comments
    only ids and sibling order are ever read. What is still open below ``levels`` is linked by
    pointer doubling. Of rows repeated under one id the first in sibling order counts, of
    equals the one with the least parent id; null ids are left out.
    """
    order = _order_columns(comments, order)
    kind, key = parent_kind(F.col("parent_id")), parent_key(F.col("parent_id"))
    rank = F.struct(_sort_text(order, comments), "parent_id")
    first = comments.filter(F.col("id").isNotNull()).groupBy("id").agg(F.min_by("parent_id", rank).alias("parent_id"))
    edges = stage(first.select("id", kind.alias("kind"), key.alias("key")).filter(F.col("kind").isNotNull()), "edges")
    replies = edges.filter("kind = 'comment'").select("id", "key")
    top = edges.filter("kind = 'post'").join(chosen.select(F.col("id").alias("key")).distinct(), "key", "left_semi")
    level = top.select("id", F.col("key").alias("post_id"), F.lit(0).alias("depth"))
    path, seen = write_stage(level, "level", n=F.count(F.lit(1)))
    paths = [path]
    while seen["n"] and len(paths) < levels:
        above = read_stages(level, paths[-1]).select(F.col("id").alias("key"), "post_id", (F.col("depth") + 1).alias("depth"))
        path, seen = write_stage(replies.join(above, "key").select(*level.columns), "level", n=F.count(F.lit(1)))
        paths.append(path)
    reached = read_stages(level, *paths)
    if not seen["n"]:
        return reached
    deepest = read_stages(level, paths[-1])
    nothing = {"chars": F.lit(0).cast("long"), "lines": F.lit(0).cast("long")}
    roots = deepest.select("id", F.lit(None).cast("string").alias("parent_comment_id"), "post_id")
    rest = replies.join(reached.select("id"), "id", "left_anti")
    rest = rest.select("id", F.col("key").alias("parent_comment_id"), F.lit(None).cast("string").alias("post_id"))
    linked, _ = _ascend(roots.unionByName(rest).withColumns(nothing), repeat=False, sizes=False)
    below = linked.filter("depth > 0").select("id", "post_id", (F.col("depth") + len(paths) - 1).alias("depth"))
    return reached.unionByName(below)
