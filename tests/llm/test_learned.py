"""Toxicity and language identification: held-out accuracy and odd inputs."""

import random

import numpy as np
from pyspark.sql import functions as F

from threadwarden.llm import language_id, toxicity

SYLLABLES = {"en": "the and ing tion er ou".split(), "de": "ein sch ung keit ü ver".split(), "fr": "eau ent é que le oir".split()}


def text_of(lang, rng, n=80):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_languages_of_held_out_texts(spark):
    rng = random.Random(1)
    rows = [(i, text_of(lang, rng), lang) for i, lang in enumerate(list(SYLLABLES) * 60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    profiles = language_id.learn_profiles(df.filter("doc_id % 4 <> 2"))
    got = {r.doc_id: r for r in language_id.identify(df, profiles).collect()}
    assert set(profiles) == set(SYLLABLES)
    assert all(got[i].lang_pred == lang and 0 < got[i].score <= 1 for i, _, lang in rows if i % 4 == 2)
    again = language_id.learn_profiles(df.filter("doc_id % 4 <> 2").repartition(9))
    assert all((profiles[k] == again[k]).all() for k in profiles)


def test_odd_texts_have_no_language(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "a"), (5, "中文"), (6, "the " * 200_000), (None, "the and")]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, score string")
    known = language_id.learn_profiles(spark.createDataFrame([(1, "the and", "en"), (2, None, "xx"), (3, "t", None)], "doc_id bigint, text string, lang string"))
    assert list(known) == ["en"]
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(df, known).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[6][0] == got[None][0] == "en" and got[6][1] > 0
    assert {r.lang_pred for r in language_id.identify(df, {}).collect()} == {"und"}
    assert language_id.identify(df.limit(0), known).count() == 0 and language_id.learn_profiles(df.limit(0).withColumn("lang", F.lit("x"))) == {}


def test_document_vector_is_the_sum_of_bound_letters():
    letters = language_id.Letters()
    a, b, space = (letters.vector(c).astype(int) for c in (ord("a"), ord("b"), 0))
    bind = lambda x, y, z: np.roll(x, 2) * np.roll(y, 1) * z
    got = language_id.document_vectors([b"A--b", b"a"], letters)
    assert (got[0] == bind(space, a, space) + bind(a, space, b) + bind(space, b, space)).all()
    assert (got[1] == bind(space, a, space)).all()


BAD = ["scumbag", "grobian", "nitwitted", "wretched"]


def labelled(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        words = text_of("en", rng, 60).split()
        toxic = int(i % 5 == 0)
        for _ in range(5 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id bigint, text string, saving string")
    return docs, spark.createDataFrame([(i, x) for i, _, x in rows], "doc_id bigint, toxic int"), {i: x for i, _, x in rows}


def test_toxicity_of_held_out_texts(spark):
    docs, labels, truth = labelled(spark)
    detector = toxicity.learn(docs, labels, F.col("doc_id") % 3 != 1)
    got = [r for r in toxicity.score_documents(docs, detector).collect() if r.doc_id % 3 == 1]
    right = sum(r.predicted == truth[r.doc_id] for r in got)
    assert right >= 0.95 * len(got) and all((r.score >= 0.7) == (r.predicted == 1) and 0 <= r.score <= 1 for r in got)
    kept = toxicity.drop_toxic(docs, detector)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in toxicity.score_documents(docs, detector).filter("predicted = 1").collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(truth) - gone)


def test_odd_texts_and_labels(spark):
    docs, labels, _ = labelled(spark)
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (3, None), (4, 7), (5, 0), (5, 1)], "doc_id bigint, toxic int"))
    detector = toxicity.learn(docs, labels, F.lit(True))
    odd = spark.createDataFrame([(1, None), (None, ""), (2, " \n"), (2, " \n"), (3, "x" * 100_000), (4, "wretched " * 50_000)], "doc_id bigint, text string")
    got = [(r.doc_id, r.predicted) for r in toxicity.score_documents(odd, detector).collect()]
    assert got[:4] == [(1, 0), (None, 0), (2, 0), (2, 0)] and all(0 <= r.score <= 1 for r in toxicity.score_documents(odd, detector).collect())
    assert toxicity.score_documents(odd.limit(0), detector).count() == 0
    nothing = toxicity.learn(docs, labels.limit(0), F.lit(True))
    assert {(r.score, r.predicted) for r in toxicity.score_documents(odd, nothing).collect()} == {(0.0, 0)}
    assert toxicity.drop_toxic(odd, nothing).count() == 6


def test_spelling_is_reversible_and_long_words_are_cut():
    spell = toxicity.Speller()
    assert len({spell(bytes([b])) for b in range(256)}) == 256 and len(spell(b"ab")) == 4 * toxicity.SPELLING
    assert b"".join(toxicity.windows(b"x" * 100)) == b"x" * 100


def test_a_word_of_one_ordinary_text_stays_a_toxic_word(spark):
    """Each bad word is in one text labelled ordinary; all of them stay words of the toxic dictionary."""
    docs, labels, truth = labelled(spark)
    stray = [(1000 + i, f"{text_of('en', random.Random(90 + i), 60)} {w}") for i, w in enumerate(BAD * 2)]
    docs = docs.unionByName(spark.createDataFrame([(i, t, "s") for i, t in stray], docs.schema))
    labels = labels.unionByName(spark.createDataFrame([(i, 0) for i, _ in stray], labels.schema))
    detector = toxicity.learn(docs, labels, F.col("doc_id") % 3 != 1)
    spell = toxicity.Speller()
    assert all(spell(w.encode()) in detector.toxic for w in BAD)
    got = [r for r in toxicity.score_documents(docs, detector).collect() if r.doc_id % 3 == 1 and r.doc_id < 1000]
    assert sum(r.predicted == truth[r.doc_id] for r in got) >= 0.95 * len(got)


def test_the_limit_with_fewest_errors():
    assert toxicity._best_limit([(0.0, 0, 5), (0.0, 1, 1), (4.0, 0, 1), (6.0, 1, 3), (9.0, 1, 2)]) == (1, 5.0)
    assert toxicity._best_limit([(3.0, 0, 5)]) == (0, 4.0)


def test_all_windows_count_and_length_lowers_the_score(spark):
    docs, labels, _ = labelled(spark)
    detector = toxicity.learn(docs, labels, F.lit(True))
    clean = text_of("en", random.Random(77), 3_000)
    bad = " ".join(BAD[:2])
    texts = [f"{bad} {clean[:400]}", f"{bad} {clean[:400]} {clean}", f"{bad} {bad} {bad} {clean[:400]}"]
    odd = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    short, long, often = [r.score for r in sorted(toxicity.score_documents(odd, detector).collect())]
    assert long < short < often


def test_no_cut_of_a_long_word_hides_a_match():
    for at in range(200):
        pieces = toxicity.overlapping(b"x" * at + b"scumbag" + b"y" * (200 - at))
        assert any(b"scumbag" in p for p in pieces) and max(map(len, pieces)) <= toxicity.WINDOW_BYTES
    assert toxicity.overlapping(b"Some words") == [b"some", b"words"]


def test_figures_of_several_dictionaries_in_one_pass():
    """Each as on its own, window by window; a window meets the ordinary dictionary once for all of them."""
    rng = random.Random(5)
    common = sorted({w.encode() for w in text_of("en", rng, 2_000).split()})
    ordinary, toxic = toxicity.train_dictionary(common), [toxicity.train_dictionary([w.encode() for w in BAD[i:]]) for i in range(3)]
    texts = [b"", b" \n", b"\x00 \xff", b"x" * 100, b"A a A", " ".join(BAD * 3).encode(), BAD[0].encode() * 30]
    texts += [f"{text_of('en', rng, 30)} {' '.join(rng.sample(BAD, 2))} {BAD[0].upper()}".encode() for _ in range(40)]
    tool, seen = toxicity.Measure(ordinary, toxic), []
    plain = tool.by_ordinary
    tool.by_ordinary = lambda spelled: seen.append(spelled) or plain(spelled)
    got = tool.figures(texts)
    windows = {w for t in texts for w in toxicity.overlapping(t)}
    assert len(seen) == len(windows) == len(set(seen))
    assert all((a == b).all() for a, b in zip(got, tool.figures(texts))) and len(seen) == len(windows)
    for nth, dictionary in enumerate(toxic):
        alone = toxicity.Measure(ordinary, [dictionary])
        saved = {w: len(plain(tool.spell(w))) - len(tool.by_toxic[nth](tool.spell(w))) for w in windows}
        for text, peak, rate in zip(texts, *got[nth].T):
            found = toxicity.overlapping(text)
            best = sorted(saved[w] for w in set(found))[-2:]
            assert peak == sum(x for x in best if x > 0)
            assert rate == (sum(x for x in map(saved.get, found) if x > 0) / len(found) if found else 0)
        assert (alone.figures(texts)[0] == got[nth]).all() and alone.figures([])[0].shape == (0, 2)
