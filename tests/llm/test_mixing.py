import pytest

from threadwarden.llm import mixing

SCHEMA = "doc_id bigint, text string, source string, size string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, s, "clash") for i, t, s in rows], SCHEMA)


def test_targets_reshare_what_full_sources_leave():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 5, "b": 2, "c": 1})
    assert got == {"a": 30.0, "b": 120.0, "c": 60.0}
    assert mixing.targets({}, {}) == {} and mixing.targets({"a": 0}, {"a": 1}) == {"a": 0.0}


def test_words_of_the_mix_meet_the_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(60)] + [(100, "only five words are here", None)]
    plan = mixing.plan_mix(frame(spark, rows)).collect()
    taken, target = {}, {}
    for r in plan:
        assert 0 <= r.taken <= 3 * r.size and r.size == len(r.size * "x") and sum(c.words for c in r.copies) == r.taken
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
    sizes = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("a", "b", "c", None)}
    assert target == mixing.targets(sizes, {"a": 5, "b": 2, "c": 1, None: 5})
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = mixing.plan_mix(frame(spark, rows[::-1]).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in plan)


def test_words_are_counted_between_ascii_white_space(spark):
    texts = ["a b c", "\x0b\x0c x\x1cy ", "", None, "  "]
    df = frame(spark, [(i, t, "s") for i, t in enumerate(texts)])
    got = {r.doc_id: r.size for r in mixing.plan_mix(df).collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 0, 4: 0}


def test_positions_invert_the_schedule(spark):
    """A source that fades in has few words early: its demand at time t is the integral to t."""
    rows = [(i, "w", "a") for i in range(1000)]
    ramp = ((0.0, 0.0), (0.5, 1.0), (1.0, 1.0))
    plan = mixing.plan_mix(frame(spark, rows), weights={"a": 1.0}, schedules={"a": ramp})
    at = sorted(c.position for r in plan.collect() for c in r.copies)
    assert len(at) == 1000 and 0 <= at[0] and at[-1] <= 1
    for t, share in ((0.25, 0.0625 / 0.75), (0.5, 0.25 / 0.75), (0.75, 0.5 / 0.75)):
        assert sum(x <= t for x in at) == pytest.approx(1000 * share, abs=2)


def test_mixed_documents_are_whole_and_in_order(spark):
    rows = [(i, f"d{i} " * 20, "ab"[i % 10 == 0]) for i in range(100)]
    df = frame(spark, rows)
    plan = {r.doc_id: [c for c in r.copies if 2 * c.words >= r.size] for r in mixing.plan_mix(df).collect()}
    mixed = mixing.mix_documents(df)
    assert mixed.columns == df.columns
    got = [r.doc_id for r in mixed.collect()]
    want = sorted((c.position, i) for i, copies in plan.items() for c in copies)
    assert got == [i for _, i in want] and len(got) > len(set(got))


def test_odd_tables(spark):
    empty = frame(spark, []) if False else frame(spark, [(1, "a", "s")]).limit(0)
    assert mixing.plan_mix(empty).count() == 0 and mixing.mix_documents(empty).count() == 0
    blank = frame(spark, [(1, None, None), (1, None, None), (None, "", "s")])
    assert [r.taken for r in mixing.plan_mix(blank).collect()] == [0, 0, 0]
    repeated = frame(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, "c d", "s")])
    assert sorted(r.taken for r in mixing.plan_mix(repeated).collect()) == [2, 2, 2]
    assert sorted(r.text for r in mixing.mix_documents(repeated).collect()) == ["a b", "a b", "c d"]
