import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

from threadwarden.llm import common, minhash

SCHEMA = "doc_id bigint, text string, node string"


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())


def brute(rows, words=2):
    sets = [shingles(t, words) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] == rows[j][0] or (both and 100 * both >= 80 * len(sets[i] | sets[j])):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return sorted((d, len(sets[i]), least[root(i)], d == least[root(i)]) for i, (d, _) in enumerate(rows))


def found(df, words=2):
    return sorted(tuple(r) for r in minhash.near_groups(df, minhash.Scheme(words=words)).collect())


def family(n, words, edits, seed, start=0):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for i in range(n):
        text = list(base)
        for _ in range(rng.randrange(edits + 1)):
            text[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield start + i, " ".join(text)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)


def test_groups_equal_brute_force(spark):
    rows = [*family(40, 60, 5, 1), *family(40, 25, 3, 2, 100), *family(30, 8, 1, 3, 200)]
    rows += [(300, None), (301, ""), (302, " \n\t"), (303, "one"), (304, "ONE"), (305, "two words"), (306, "a b"), (307, "a b")]
    rows += [(308, "long " * 30_000 + "tail"), (309, "long " * 30_001 + "tail")]
    assert found(frame(spark, rows)) == brute(rows)


def test_mixed_buckets_in_small_blocks(spark, monkeypatch):
    """Families at the limit fall into several components; blocks of a bucket must all meet."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 7)
    rows = [*family(70, 30, 6, 5)]
    assert found(frame(spark, rows)) == brute(rows)


def test_one_hot_group_over_many_partitions(spark):
    rows = [*family(150, 40, 2, 8), *[(1000 + i, "exactly the same words here") for i in range(300)]]
    assert found(frame(spark, rows).repartition(40)) == brute(rows)


def test_null_ids_repeats_and_empty_table(spark):
    df = frame(spark, [(None, "lonely words"), (None, "shared words here"), (4, "shared words here"), (4, "shared words here")])
    rows = minhash.near_groups(df, minhash.Scheme(words=2)).collect()
    assert sorted(((r.doc_id, r.component_id, r.kept) for r in rows), key=str) == sorted(
        [(None, None, True), (None, 4, False), (4, 4, True), (4, 4, True)], key=str
    )
    assert minhash.near_groups(df.limit(0)).count() == 0
    kept = minhash.drop_near_copies(df, minhash.Scheme(words=2))
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.text) for r in kept.collect()) == [
        (False, "shared words here"), (True, "lonely words"), (True, "shared words here")
    ]


@pytest.mark.parametrize("scheme", [minhash.Scheme(), minhash.Scheme(slots=48, distance=17, chunk_errors=2)])
def test_every_pair_within_the_distance_shares_a_key(scheme):
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (500, scheme.slots)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(scheme.slots, scheme.distance, replace=False)] ^= 1
    assert (scheme.bucket_keys(a) == scheme.bucket_keys(b)).any(axis=1).all()


def test_signatures_estimate_similarity():
    scheme = minhash.Scheme(slots=512, distance=100)
    sets = [minhash.shingle_set(" ".join(f"x{i}" for i in r).encode(), 1) for r in (range(900), range(100, 1000))]
    a, b = scheme.signatures(sets)
    assert abs((a == b).mean() - 0.8) < 0.06


def test_slices_of_a_text_do_not_change_its_shingles(monkeypatch):
    text = b"Some words  and\tmore of them " * 50
    whole = minhash.shingle_set(text, 3)
    monkeypatch.setattr(minhash, "SLICE_BYTES", 10)
    assert (minhash.shingle_set(text, 3) == whole).all()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (5, 5)], "a bigint, b bigint")
    got = dict(map(tuple, common.connected_components(edges).collect()))
    assert got == {**{i: 0 for i in range(201)}, 900: 900, 901: 900}


def test_runs_are_whole():
    keys = [1, 1, 2, 2, 2, 2, 2, 3, 4, 4]
    for size in (1, 2, 3, 10):
        parts = [pa.RecordBatch.from_pydict({"k": keys[i : i + size]}) for i in range(0, len(keys), size)]
        tables = [t.column("k").to_pylist() for t in common.runs(iter(parts), "k")]
        assert sum(tables, []) == keys
        assert all(not set(x) & set(y) for i, x in enumerate(tables) for y in tables[:i])


def test_a_pair_at_the_limit_whose_signatures_differ_in_many_slots(spark):
    """Similarity 0.8; 25 of 64 slots differ, nearly twice the mean."""
    rows = [(i, " ".join(f"s518x{k}" for k in r)) for i, r in enumerate((range(90), range(10, 100)))]
    scheme = minhash.Scheme(words=1)
    a, b = scheme.signatures([minhash.shingle_set(text.encode(), 1) for _, text in rows])
    assert (a != b).sum() == 25
    assert found(frame(spark, rows), 1) == brute(rows, 1)


def test_links_of_a_crowded_cell(monkeypatch):
    """They join the same components as all similar pairs do, whatever number of pairs waits; one link a join."""
    rng = np.random.default_rng(3)
    base = np.arange(100)
    sets = [np.sort(rng.choice(130, 100, replace=False)) for _ in range(30)]
    sets += [np.r_[base[: 100 - n], 1000 * n + np.arange(n)] for n in (0, 9, 10, 11, 12, 30)]
    sets += [base[:80], base[:79], base[:1], np.array([-(2**63)]), base[:1], np.array([7, 2**63 - 1])]
    components = np.arange(len(sets)) % 37
    shingles = pa.chunked_array([pa.array([s.tolist() for s in part], pa.list_(pa.int64())) for part in (sets[:5], sets[5:])])

    def closed(links):
        group = components.copy()
        for i, j in links:
            group[group == group[j]] = group[i]
        return {tuple(np.flatnonzero(group == g)) for g in group}

    similar = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
    pairs = list(itertools.combinations(range(len(sets)), 2))
    right = [(i, j) for i, j in pairs if similar(set(sets[i].tolist()), set(sets[j].tolist()))]
    steps = [(np.arange(len(sets) - k), np.arange(k, len(sets))) for k in range(1, len(sets))]
    for waiting in (1, 50, 1 << 18):
        monkeypatch.setattr(minhash, "PAIRS_AT_A_TIME", waiting)
        found = list(minhash._links_of(shingles, components, iter(steps), 80))
        links = [(i, j) for a, b in found for i, j in zip(a.tolist(), b.tolist())]
        assert closed(links) == closed(right) and set(links) <= set(right)
        assert len(links) == len(set(components.tolist())) - len(closed(right))
        assert list(minhash._links_of(shingles, components, iter([]), 80)) == []
