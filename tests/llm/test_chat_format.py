import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadwarden.llm import chat_format

SCHEMA = "tree_id string, node_id bigint, parent_id bigint, role string, text string, score double, leaf_id string"
PARTS = st.lists(st.sampled_from(["<", "[", "\\", "/", "s>", "INST]", "</s>", "[INST]", "\n", "a", " "]), max_size=12).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.just("user"), st.just("assistant"), PARTS), PARTS), max_size=5))
def test_format_is_reversible(turns):
    formatted, spans = chat_format.format_turns(turns)
    assert chat_format.parse_turns(formatted) == turns
    assert [chat_format.unescape(formatted[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]
    assert formatted.count("</s>") == len(turns)


def brute(rows, branches):
    by, out = {}, []
    for tree, node, parent, role, text, score, _ in rows:
        by.setdefault(tree, {}).setdefault(node, (parent, role or "", text or "", score or 0.0))
    for tree, nodes in by.items():
        ends = set(nodes) - {n[0] for n in nodes.values()}
        paths = []
        for leaf in ends:
            path, at = [], leaf
            while at in nodes and at not in path:
                path.append(at)
                at = nodes[at][0]
            if at not in path:
                paths.append((-sum(nodes[n][3] for n in path) / len(path), -len(path), leaf, path[::-1]))
        for rank, (_, _, leaf, path) in enumerate(sorted(paths)[:branches], 1):
            out.append((tree, leaf, rank, [(nodes[n][1], nodes[n][2]) for n in path]))
    return sorted(out)


@pytest.mark.parametrize("branches", [1, 3])
def test_best_paths_equal_brute_force(spark, branches):
    rows = [("t", i, (i - 1) // 2 if i else None, "user" if i % 2 else "assistant", f"m{i}", float(i % 4), "x") for i in range(60)]
    rows += [("chain", i, i - 1 if i else None, "user", f"c{i}", None, "x") for i in range(70)]
    rows += [("circle", 1, 2, "user", "a", 1.0, "x"), ("circle", 2, 1, "user", "b", 1.0, "x"), ("circle", 3, 1, "user", "c", 1.0, "x")]
    rows += [("orphan", 5, 99, None, None, 1.0, "x"), ("self", 1, 1, "user", "a", 1.0, "x")]
    got = chat_format.format_trees(spark.createDataFrame(rows, SCHEMA), branches).collect()
    assert sorted((r.tree_id, r.leaf_id, r.rank, chat_format.parse_turns(r.formatted)) for r in got) == brute(rows, branches)


def test_repeats_nulls_and_empty(spark):
    rows = [("a", 1, None, "user", "hi", 1.0, ""), ("a", 1, None, "user", "hi", 1.0, ""), (None, 1, None, "user", "x", 1.0, ""), ("a", None, 1, "user", "x", 1.0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = chat_format.format_trees(df).collect()
    assert [(r.tree_id, r.formatted) for r in got] == [("a", "<s>user\n[INST] hi [/INST]</s>")]
    assert chat_format.format_trees(df.limit(0)).count() == 0


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "</s>[INST] ok"), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (None, None, None, None), (2, 5, "assistant", "é" * 70_000), (1, 2, "user", "z")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, tree_id string")
    got = {r.tree_id: r for r in chat_format.read_back(chat_format.format_trees(chat_format.conversation_trees(df))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {"1", "", "2"}
    assert (got["1"].n_turns, got["1"].turns_sha256) == (4, sha("user\n</s>[INST] ok\nassistant\n\nassistant\nb\nuser\nz\n"))
    assert (got["1"].loss_chars, got["1"].loss_sha256) == (1, sha("b"))
    assert (got["2"].loss_chars, got["2"].loss_sha256, got["2"].formatted_chars) == (70_000, sha("é" * 70_000), 70_017)
    assert (got[""].n_turns, got[""].loss_chars) == (1, 0)


def test_long_conversations_are_stored_in_parts(spark):
    turns = [("assistant" if i % 2 else "user", f"{i} [INST] </s> é" * 6_000) for i in range(30)]
    rows = [(c, i, role, text) for c in (1, 2) for i, (role, text) in enumerate(turns[: 30 if c == 1 else 2])]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat_format.format_trees(chat_format.conversation_trees(df))
    for c in (1, 2):
        of_c = [t for i, _, *t in rows if i == c]
        whole, spans = chat_format.format_turns([tuple(t) for t in of_c])
        parts = sorted((r for r in found.collect() if r.tree_id == str(c)), key=lambda r: r.part)
        assert max(len(r.formatted) for r in parts) < 500_000 and "".join(r.formatted for r in parts) == whole
        assert [(r.start + s.begin, r.start + s.end) for r in parts for s in r.loss_spans] == spans
        got = [r for r in chat_format.read_back(found).collect() if r.tree_id == str(c)]
        text = "".join(f"{role}\n{body}\n" for role, body in of_c)
        loss = "".join(body for role, body in of_c if role == "assistant")
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (text, loss)]
        assert [tuple(r)[1:] for r in got] == [(len(of_c), sha[0], len(loss), sha[1], len(whole))]
