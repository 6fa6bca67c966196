"""Reply trees and conversation texts, against a plain walk over small tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from threadwarden.operators import threads

POST_DDL = "id string, title string, selftext string, author string, ord bigint"
COMMENT_DDL = "id string, parent_id string, body string, author string, ord bigint"


def walk(posts, comments):
    """Expected text per post id; every row copy of a comment is visited."""
    texts, kids = {}, defaultdict(list)
    for row in sorted(comments, key=lambda c: c[4]):
        texts.setdefault(row[0], (row[3] or "[Unknown Author]", row[2] or "[No Content]"))
        kids[row[1]].append(row[0])

    def below(key, depth, parent):
        out = []
        for cid in kids[key]:
            author, body = texts[cid]
            lines = [f"Comment ID: {cid}"]
            if parent:
                lines.append(f"This comment is a reply to parent comment: {parent}")
            lines += [f"Comment Author: {author}", f"Comment Body: {body}", "-" * 30]
            out.append("".join("  " * depth + line + "\n" for line in lines))
            out.append(below("t1_" + cid, depth + 1, cid))
        return "".join(out)

    expected = {}
    for pid, title, selftext, author, _ in posts:
        if pid not in expected:
            head = f"Post ID: {pid}\nPost Title: {title or '[No Title]'}\nPost Content: {selftext or '[No Content]'}\n"
            head += f"Post Author: {author or '[Unknown Author]'}\n" + "-" * 50 + "\n"
            expected[pid] = head + (below("t3_" + pid, 0, None) or "No comments\n")
    return expected


def frames(spark, posts, comments):
    return spark.createDataFrame(posts, POST_DDL), spark.createDataFrame(comments, COMMENT_DDL)


def whole(df):
    got = defaultdict(dict)
    for r in df.collect():
        assert r.part not in got[r.post_id]
        got[r.post_id][r.part] = r.full_conversation
    return {k: "".join(v[p] for p in sorted(v)) for k, v in got.items()}


POSTS = [
    ("p1", "A title", "some text", "ann", 1),
    ("p2", None, None, None, 2),
    ("p3", "alone", "nobody answers", "bob", 3),
]
COMMENTS = [
    ("a", "t3_p1", "first", "bob", 10),
    ("b", "t1_a", "line one\nline two", None, 11),
    ("c", "t1_b", None, "cid", 12),
    ("d", "t1_c", "deeper", "dan", 13),
    ("e", "t1_d", "deepest \U0001f600", "eve", 14),
    ("f", "t3_p1", "sibling 2", "fay", 2),
    ("g", "t3_p1", "sibling -5", "gus", -5),
    ("h", "t3_p2", "other thread", "hal", 20),
    ("orphan", "t1_gone", "lost", "x", 30),
    ("below_orphan", "t1_orphan", "lost too", "x", 31),
    ("stranger", "t3_nowhere", "unknown post", "x", 32),
    ("loop1", "t1_loop2", "round", "x", 33),
    ("loop2", "t1_loop1", "and round", "x", 34),
    ("odd", "x9_p1", "no kind", "x", 35),
    ("none", None, "no parent", "x", 36),
]


def test_conversations_of_a_small_forum(spark):
    posts, comments = frames(spark, POSTS, COMMENTS)
    result = threads.compose(posts, comments)
    assert whole(result) == walk(POSTS, COMMENTS)


def test_parts_and_beginnings_are_cuts_of_the_whole(spark):
    posts, comments = frames(spark, POSTS, COMMENTS)
    expected = walk(POSTS, COMMENTS)
    parts = threads.compose(posts, comments, part_chars=60)
    assert parts.filter("part > 0").count() > 0
    assert whole(parts) == expected
    cut = threads.compose(posts, comments, max_chars=150)
    assert whole(cut) == {k: v[:150] for k, v in expected.items()}


def test_unreached_comments_have_a_reason(spark):
    posts, comments = frames(spark, POSTS, COMMENTS)
    gaps = threads.unreached_comments(posts, comments, threads.link_comments(comments))
    assert {r.id: r.reason for r in gaps.collect()} == {
        "orphan": "missing comment",
        "below_orphan": "missing comment",
        "loop1": "cycle",
        "loop2": "cycle",
        "odd": "unreadable parent",
        "none": "unreadable parent",
        "stranger": "unknown post",
    }


def test_first_copy_stands_for_an_id(spark):
    later = [(i, p, "changed", "zoe", o + 1000) for i, p, _, _, o in COMMENTS]
    posts, comments = frames(spark, POSTS + [("p1", "late title", "late", "zoe", 99)], COMMENTS + later)
    assert whole(threads.compose(posts, comments)) == walk(POSTS, COMMENTS)


def test_exact_copies_are_shown_once(spark):
    posts, comments = frames(spark, POSTS + POSTS, COMMENTS * 3)
    assert whole(threads.compose(posts, comments)) == walk(POSTS, COMMENTS)


def test_copies_multiply_on_request(spark):
    sound = [c for c in COMMENTS if not c[0].startswith("loop")]
    copies = [("a", "t3_p1", "copy", "bob", 110), ("b", "t1_a", "copy", "bob", 111), ("b", "t1_a", "copy", "bob", 111)]
    posts, comments = frames(spark, POSTS + [POSTS[2]], sound + copies)
    rows = threads.compose(posts, comments, duplicates="repeat").collect()
    expected = walk(POSTS, sound + copies)
    assert sorted((r.post_id, r.full_conversation) for r in rows) == sorted([*expected.items(), ("p3", expected["p3"])])


def test_copied_cycles_end(spark):
    """Two comments that answer each other, held twice each, and a copy that answers its own reply."""
    loop = [("x", "t1_y", "b", "a", 1), ("y", "t1_x", "b", "a", 2)] * 2
    back = [("r", "t3_p1", "b", "a", 3), ("s", "t1_r", "b", "a", 4), ("r", "t1_s", "b", "a", 5)]
    _, comments = frames(spark, POSTS, loop + back)
    got = threads.link_comments(comments, duplicates="repeat").collect()
    assert sorted((r.id, r.depth) for r in got) == [("r", 0), ("s", 1)]


def test_siblings_follow_real_times(spark):
    """Sub-second times, microseconds as numbers and decimals keep their order; null comes last."""
    times = [0.9, 0.1, None, -1.5, 1.7e15, 3.0]
    rows = [(f"c{i}", "t3_p1", "b", "a", t) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "id string, parent_id string, body string, author string, created double")
    want = ["c3", "c1", "c0", "c5", "c4", "c2"]
    casts = ["created", "cast(created as decimal(30,6))", "timestamp_micros(cast(if(created > 1e9, 1e9, created) * 1000000 as bigint))"]
    for shown in casts:
        tree = threads.link_comments(df.withColumn("created", F.expr(shown))).orderBy("sibling")
        assert [r.id for r in tree.collect()] == want, shown


def test_random_forest_matches_a_plain_walk(spark):
    rng = random.Random(7)
    posts = [(f"p{i}", rng.choice([None, f"t{i}"]), f"text {i}", "ann", i) for i in range(40)]
    comments, ids = [], []
    order = list(range(1500))
    rng.shuffle(order)
    for n in range(1500):
        if not ids or rng.random() < 0.2:
            parent = f"t3_p{rng.randrange(44)}"
        else:
            # mostly recent parents, so that chains grow long
            parent = "t1_" + (ids[-1] if rng.random() < 0.6 else rng.choice(ids))
        ids.append(f"c{n}")
        comments.append((f"c{n}", parent, f"body {n}" * rng.randrange(1, 4), f"u{n % 9}", order[n]))
    frame = frames(spark, posts, comments)
    expected = walk(posts, comments)
    assert whole(threads.compose(*frame, duplicates="none")) == expected
    assert whole(threads.compose(*frame, part_chars=500)) == expected


def test_long_chain(spark):
    chain = [(f"c{i}", f"t1_c{i - 1}" if i else "t3_p1", "x", "u", i) for i in range(300)]
    tree = threads.link_comments(spark.createDataFrame(chain, COMMENT_DDL))
    assert {r.id: r.depth for r in tree.collect()} == {f"c{i}": i for i in range(300)}


def test_chain_of_a_hundred_thousand(spark):
    """Rows keep their width whatever the depth, and so do offsets along the whole chain."""
    n = 100_000
    chain = spark.range(n).select(
        F.concat(F.lit("c"), "id").alias("id"),
        F.when(F.col("id") == 0, "t3_p1").otherwise(F.concat(F.lit("t1_c"), F.col("id") - 1)).alias("parent_id"),
        F.lit("x").alias("body"),
        F.lit("u").alias("author"),
        F.col("id").alias("ord"),
    )
    posts = spark.createDataFrame(POSTS[:1], POST_DDL)
    tree = threads.link_comments(chain, duplicates="none", sizes=True)
    assert not [f for f in tree.schema if f.dataType.typeName() in ("array", "map", "struct")]
    placed = threads.place_lines(posts, tree).filter("depth >= 0").select("id", "depth", "offset")
    got = placed.agg(F.count(F.lit(1)), F.max("depth"), F.sum("depth"), F.max("offset")).first()
    # header, then per comment its five lines (four for the first), each indented by its depth
    size = lambda i: len(f"Comment ID: c{i}\n") + (len(f"This comment is a reply to parent comment: c{i - 1}\n") if i else 0) + len("Comment Author: u\nComment Body: x\n") + 31
    head = len(walk(POSTS[:1], [])["p1"]) - len("No comments\n")
    last = head + sum(size(i) + 2 * i * (5 if i else 4) for i in range(n - 1))
    assert tuple(got) == (n, n - 1, n * (n - 1) // 2, last)


def test_copies_under_several_parents(spark):
    """An id held under two parents brings its replies under each, also when it answers its own reply."""
    rows = [("a", "t3_p1", "b", "u", 1), ("b", "t3_p1", "b", "u", 2), ("m", "t1_a", "b", "u", 3), ("m", "t1_b", "b", "u", 4), ("m", "t1_b", "b", "u", 5),
            ("k", "t1_m", "b", "u", 6), ("k2", "t1_k", "b", "u", 7)]
    posts, comments = frames(spark, POSTS, rows)
    assert whole(threads.compose(posts, comments, duplicates="repeat")) == walk(POSTS, rows)
    _, comments = frames(spark, POSTS, [*rows, ("a", "t1_k2", "b", "u", 8)])
    text = whole(threads.compose(posts, comments, duplicates="repeat"))["p1"]
    # under b the path b, m, k, k2, a goes on; under a it may not meet a again
    assert text.count("Comment ID: k2\n") == 3 and text.count("Comment ID: a\n") == 3


def test_beginnings_follow_few_lines(spark):
    """Lines that begin behind the limit are not placed, however large the thread."""
    rng = random.Random(3)
    rows = [(f"c{i}", f"t1_c{rng.randrange(i)}" if i and rng.random() < 0.9 else "t3_p1", "text", "u", i) for i in range(3000)]
    posts, comments = frames(spark, POSTS[:1], rows)
    tree = threads.link_comments(comments, sizes=True)
    every = threads.place_lines(posts, tree).select("id", "depth", "offset", "n_comments").collect()
    few = threads.place_lines(posts, tree, max_chars=2000).select("id", "depth", "offset", "n_comments").collect()
    assert sorted(few, key=str) == sorted([r for r in every if r.offset < 2000], key=str) and len(every) == 3001
    assert whole(threads.compose(posts, comments, max_chars=2000))["p1"] == walk(POSTS[:1], rows)["p1"][:2000]


def test_creation_time_orders_siblings_without_ord(spark):
    comments = spark.createDataFrame(
        [("b", "t3_p1", "x", "u", 20.5), ("a", "t3_p1", "x", "u", 20.25), ("c", "t3_p1", "x", "u", None), ("d", "t3_p1", "x", "u", -3.0)],
        "id string, parent_id string, body string, author string, created double",
    )
    tree = threads.link_comments(comments).orderBy("sibling")
    assert [r.id for r in tree.collect()] == ["d", "a", "b", "c"]


def test_one_hot_parent_is_spread(spark):
    """Two thirds of the comments answer one comment; the join must lose none."""
    hot = [("top", "t3_p1", "x", "u", 0)] + [(f"h{i}", "t1_top", "x", "u", i) for i in range(1, 400)]
    rest = [(f"r{i}", f"t1_h{i}", "x", "u", i) for i in range(1, 200)]
    tree = threads.link_comments(spark.createDataFrame(hot + rest, COMMENT_DDL))
    assert tree.groupBy("depth").count().orderBy("depth").collect() == [(0, 1), (1, 399), (2, 199)]


def test_comments_of_posts_and_top_level(spark):
    posts, comments = frames(spark, POSTS, COMMENTS)
    chosen = posts.filter(F.col("id") == "p1")
    members = threads.comments_of_posts(threads.link_comments(comments), chosen, comments)
    assert {r.id for r in members.collect()} == set("abcdefg")
    top = threads.top_level_comments(posts, comments)
    assert {(r.id, r.post_id) for r in top.collect()} == {("a", "p1"), ("f", "p1"), ("g", "p1"), ("h", "p2")}


@pytest.mark.parametrize("levels", [1, 2, 24])
def test_reached_comments_are_those_of_the_linked_tree(spark, levels):
    """Level by level, or by doubling below the first levels, with copies of ids and cycles around."""
    rng = random.Random(11)
    rows = [(f"c{i}", f"t1_c{i - 1 - rng.randrange(min(i, 3))}" if i % 60 else f"t3_p{i // 60}", "b", "u", i) for i in range(240)]
    rows += COMMENTS + [("c7", "t3_p3", "later copy", "u", 9999)]
    posts, comments = frames(spark, POSTS, rows)
    chosen = posts.filter("id <> 'p3'")
    tree = threads.link_comments(comments).filter("post_id in ('p1', 'p2')").select("id", "post_id", "depth")
    got = threads.reach_comments(chosen, comments, levels=levels)
    assert sorted(got.collect()) == sorted(tree.collect()) and got.count() > 120
    assert threads.reach_comments(chosen.limit(0), comments, levels=levels).count() == 0


def test_columns_of_the_post_are_kept(spark):
    posts = spark.createDataFrame([("p1", "t", "x", "u", 2, "late"), ("p1", "t", "y", "u", 1, "s1"), ("p2", "t", "z", "u", 1, None)],
                                  "id string, title string, selftext string, author string, ord bigint, subreddit string")
    comments = spark.createDataFrame(COMMENTS, COMMENT_DDL)
    got = threads.compose(posts, comments, part_chars=60, keep=["subreddit", "ord"])
    assert got.columns == ["post_id", "part", "full_conversation", "subreddit", "ord"]
    assert {(r.post_id, r.subreddit, r.ord) for r in got.collect()} == {("p1", "s1", 1), ("p2", None, 1)}


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"comments: \['body', 'author'\]"):
        threads.link_comments(spark.createDataFrame([("a", "t3_p")], "id string, parent_id string"))
    with pytest.raises(ValueError, match="duplicates"):
        threads.link_comments(spark.createDataFrame(COMMENTS, COMMENT_DDL), duplicates="some")


def test_leaves_are_peeled_off_before_pointers_double(spark, monkeypatch):
    """Bushy trees, a chain, cycles with trees on them and lost replies: the doubling carries few rows, results are whole."""
    rng = random.Random(7)
    rows = [(f"c{i}", f"t1_c{rng.randrange(i)}" if i > 2 else f"t3_p{i % 2 + 1}", "text" * (1 + i % 3), "u", i) for i in range(400)]
    rows += [(f"k{i}", f"t1_k{i - 1}" if i else "t1_c9", "x", "u", 1000 + i) for i in range(40)]
    rows += [("r1", "t1_r2", "x", "u", 2000), ("r2", "t1_r1", "x", "u", 2001), ("o", "t1_gone", "x", "u", 2002)]
    rows += [(f"r1_{i}", "t1_r1", "x", "u", 2010 + i) for i in range(20)] + [(f"o{i}", "t1_o", "x", "u", 2040 + i) for i in range(9)]
    posts, comments = frames(spark, POSTS, rows)

    def results():
        tree = threads.link_comments(comments, sizes=True)
        bare = threads.link_comments(comments).select("id", "post_id", "depth", "parent_comment_id")
        placed = [threads.place_lines(posts, tree, max_chars=n) for n in (None, 900)]
        shown = tree.select("id", "post_id", "depth", "chars_below", "lines_below", "comments_below")
        return [sorted(map(tuple, df.collect()), key=str) for df in (shown, bare, *[p.select("post_id", "id", "depth", "offset", "n_comments") for p in placed])]

    plain = results()
    doubled = []
    ascend = threads._ascend
    monkeypatch.setattr(threads, "_ascend", lambda nodes, *a: doubled.append(nodes.count()) or ascend(nodes, *a))
    monkeypatch.setattr(threads, "PEEL_ROWS", 20)
    assert results() == plain and len(plain[0]) == 440
    assert max(doubled) < len(rows) / 2
    assert whole(threads.compose(posts, comments)) == walk(POSTS, rows)


def test_small_families_are_summed_in_one_window(spark, monkeypatch):
    """Only replies to a parent with more than FAMILY_ROWS of them go through slices; the text is the same."""
    rows = [(f"h{i}", "t3_p1" if i % 2 else "t1_f", "x" * (1 + i % 5), "u", 1000 - i) for i in range(60)]
    rows += COMMENTS + [(f"r{i}", f"t1_h{i}", "y", "u", i) for i in range(30)]
    posts, comments = frames(spark, POSTS, rows)
    expected = walk(POSTS, rows)
    sliced = []
    running_total = threads.running_total

    def counted(df, *a, **b):
        sliced.append(sorted({r.family for r in df.select("family").collect()}))
        return running_total(df, *a, **b)

    monkeypatch.setattr(threads, "running_total", counted)
    assert whole(threads.compose(posts, comments)) == expected and not sliced
    monkeypatch.setattr(threads, "FAMILY_ROWS", 20)
    assert whole(threads.compose(posts, comments)) == expected and sliced == [["cf", "pp1"]]


def test_ids_without_copies_are_counted_once(spark, monkeypatch):
    """Repeated posts are still shown once when no comment is repeated."""
    seen = []
    any_repeated = threads._any_repeated
    monkeypatch.setattr(threads, "_any_repeated", lambda df, keys: seen.append(sorted(df.columns)) or any_repeated(df, keys))
    posts, comments = frames(spark, POSTS + POSTS, COMMENTS)
    assert whole(threads.compose(posts, comments)) == walk(POSTS, COMMENTS)
    assert len(seen) == 2 and "parent_id" in seen[0] and "title" in seen[1]
