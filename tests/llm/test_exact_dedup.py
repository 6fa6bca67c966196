import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from threadwarden.llm import exact_dedup

SCHEMA = "doc_id bigint, text string, digest string"


def brute(rows):
    norm = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[norm(text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256(norm(text).encode()).hexdigest()))
    return sorted(out, key=str)


def found(df):
    rows = exact_dedup.exact_groups(df).collect()
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in rows], key=str)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000, 40_000])
def test_filter_holds_its_keys_and_few_others(n):
    keys = np.random.default_rng(n).integers(-(2**63), 2**63, 2 * n)
    made = exact_dedup.build_filter(keys[:n])
    assert exact_dedup.probe_filter(keys[:n], *made).all()
    if n >= 1000:
        assert exact_dedup.probe_filter(keys[n:], *made).mean() < 0.01


@settings(max_examples=20, deadline=None)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), min_size=1, max_size=60))
def test_filter_of_any_keys(keys):
    assert exact_dedup.probe_filter(np.array(keys), *exact_dedup.build_filter(np.array(keys))).all()


def test_groups_equal_brute_force(spark):
    texts = ["Same", "sAME", "same", None, "", "Über", "über", "ÜBER", "x" * 50_000, "X" * 50_000, "a  b", "a b"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, "copy") for i in range(300)] + [(7, "über"), (7, "über"), (3, "other")]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    assert found(df) == brute(rows)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a", ""), (None, "A", ""), (5, "b", ""), (None, "b", "")], SCHEMA)
    assert found(df) == brute([(None, "a"), (None, "A"), (5, "b"), (None, "b")])
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    assert exact_dedup.drop_copies(df.limit(0)).count() == 0


def test_copies_in_batch_and_snapshot_meet(spark):
    """Either side of the split, and across it."""
    df = spark.createDataFrame([(i, f"t{i % 3}", "") for i in range(30)], SCHEMA)
    left = exact_dedup.exact_groups(df, F.col("doc_id") < 15).collect()
    assert {r.keep_id for r in left} == {27, 28, 29} and {r.group_size for r in left} == {10}


def test_drop_copies_keeps_columns_and_one_of_repeats(spark):
    rows = [(1, "a", "x"), (2, "A", "y"), (2, "A", "y"), (3, "b", "z"), (None, "c", "w"), (3, "d", "v")]
    kept = exact_dedup.drop_copies(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "digest"]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(2, "A"), (3, "b"), (None, "c"), (3, "d")], key=str)
    plain = exact_dedup.drop_copies(spark.createDataFrame([(i, "ab"[i % 2], "") for i in range(6)], SCHEMA))
    assert sorted(r.doc_id for r in plain.collect()) == [4, 5]


def test_byte_check_hashes_only_texts_of_positives(spark):
    """Digests are no key of the join that finds the texts, and texts are not sorted for it."""
    rows = [(1, "Same"), (2, "sAME"), (None, "same"), (3, None), (4, ""), (7, "Same"), (7, "other"), (7, "other"), (None, None)]
    rows += [(50, f"text {i}") for i in range(200)] + [(100 + i, f"TEXT {i}") for i in range(200)]
    df = spark.createDataFrame([(i, t, "") for i, t in rows], SCHEMA)
    assert found(df) == brute(rows)
    digest = lambda t: hashlib.sha256(t.encode()).digest()
    pairs = [(digest("same"), 1), (digest("same"), 7), (digest(""), 3), (digest(""), None), (digest("absent"), 7)]
    pairs += [(digest(f"text {i}"), d) for i in range(200) for d in (50, 100 + i)]
    pairs = spark.createDataFrame(pairs, "digest binary, doc_id bigint")
    checked = exact_dedup.differing_bytes(df, pairs)
    assert checked.count() == 0
    plan = checked._jdf.queryExecution().executedPlan().toString()
    assert "sha2" not in plan and "translate" not in plan and "BroadcastHashJoin" not in plan
    assert "ShuffledHashJoin [doc_id" in plan and plan.count("MapInArrow") == 1
