import os

import corpus_pipeline
import __spark_entry__ as entry
from threadwarden.llm import mixing, toxicity
from threadwarden.sources.staging import stage

DATA = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    seen = []
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, DATA), name)
        seen.append((name, docs, out))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        docs = out
    rows = {name: (before.collect(), after.collect()) for name, before, after in seen}
    ids = lambda side: [r.doc_id for r in side]

    before, after = rows["toxicity"]
    assert set(ids(after)) < set(ids(before))
    before, after = rows["exact_dedup"]
    last = {}
    for r in before:
        last[r.text.encode().lower()] = max(last.get(r.text.encode().lower(), -1), r.doc_id)
    assert sorted(ids(after)) == sorted(last.values())
    before, after = rows["minhash_near_dedup"]
    assert sorted(ids(after)) == _first_of_near(before)
    before, after = rows["mixing"]
    plan = mixing.plan_mix(seen[3][1]).collect()
    want = sorted((c.position, r.doc_id) for r in plan for c in r.copies if 2 * c.words >= r.size)
    assert sorted(ids(after)) == sorted(i for _, i in want)
    before, after = rows["sentencepiece"]
    assert sorted(ids(after)) == sorted(ids(before)) and all(r.round_trip and len(r.token_ids) == r.n_tokens for r in after)


def _first_of_near(rows):
    sets = {}
    for r in rows:
        w = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    order = sorted(sets)
    for i in order:
        for j in order:
            if j < i and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return sorted({root(i) for i in order})


def test_every_operator_is_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert all(os.path.basename(k) == k for k in names)


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == ["doc_id", "lang", "source", "token_ids", "n_tokens", "round_trip"]
    assert toxicity.THRESHOLD == 0.7
