import json
import os
import random
import re
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

import example_tables as ex
from threadwarden.operators import assess
from threadwarden.sources import ledger, staging
from threadwarden.operators.assess import ScorerError


# workers cannot import test modules
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def response(scores, **extra):
    return json.dumps({"attributeScores": scores, **extra})


def score(value, *spans):
    return {"summaryScore": {"value": value}, "spanScores": [{"begin": b, "end": e, "score": {"value": v}} for b, e, v in spans]}


@pytest.fixture(scope="module")
def calls(spark):
    rows = {
        "full": response({"TOXICITY": score(0.5, (0, 3, 0.1), (4, 9, 0.7), (10, 12, 0.7)), "THREAT": score(0.5, (0, 5, 0.2))}, languages=["en", "fr"], detectedLanguages=["en"]),
        "bare": response({"THREAT": score(0.9)}),
        "broken": "{bad",
        "null": None,
    }
    data = [(k, "some text here", 14, v) for k, v in rows.items()]
    return spark.createDataFrame(data, "post_id string, text string, text_length int, response_json string")


def test_flat_scores(calls):
    flat = {r.post_id: r for r in assess.flatten_scores(assess.parse_responses(calls), ["toxicity", "threat", "insult"]).collect()}
    assert set(flat) == {"full", "bare"}
    full, bare = flat["full"], flat["bare"]
    assert (full.toxicity_score, full.toxicity_max_span_begin, full.toxicity_max_span_end) == (0.5, 4.0, 9.0)
    assert (full.languages, full.detected_languages, full.insult_score) == ("en fr", "en", None)
    assert (bare.threat_score, bare.threat_max_span_begin, bare.languages, bare.toxicity_score) == (0.9, None, None, None)


def test_broken_json_is_an_error_row(calls):
    errors = assess.parse_error_rows(assess.parse_responses(calls)).collect()
    assert [(r.post_id, r.message, r.details) for r in errors] == [("broken", "JSONDecodeError", "{bad")]


def test_ranked_attributes(calls):
    ranked = {r.post_id: r for r in assess.ranked_attributes(assess.parse_responses(calls)).collect()}
    full = ranked["full"]
    assert (full.max_score, full.max_score_attribute) == (0.5, "TOXICITY")
    assert [(s.attribute, [t.text for t in s.spans]) for s in full.scores] == [("TOXICITY", ["som", " text", "he"]), ("THREAT", ["some "])]


def scripted():
    """429 then an answer; 429 for ever; 400; nothing; a crash."""
    seen = {}

    def call(text):
        seen[text] = seen.get(text, 0) + 1
        if text == "slow" and seen[text] == 1 or text == "jam":
            raise ScorerError(429, "slow down")
        if text == "bad":
            raise ScorerError(400, "no")
        if text == "crash":
            raise RuntimeError("boom")
        return None if text == "nothing" else json.dumps({"echo": text})

    return call


def test_retries_and_errors(spark):
    texts = ["fine", "slow", "jam", "bad", "nothing", "crash"]
    conversations = spark.createDataFrame([(t, t) for t in texts] + [("null", None)], "post_id string, full_conversation string")
    results = assess.call_scorer(assess.prepare(conversations), scripted, backoff=0.0).cache()
    got = {r.post_id: (r.response_json is not None, r.attempts, len(r.errors)) for r in results.collect()}
    assert got == {"fine": (True, 1, 0), "slow": (True, 2, 1), "jam": (False, 2, 2), "bad": (False, 1, 1), "nothing": (False, 1, 1), "crash": (False, 1, 1)}
    errors = sorted((r.post_id, r.error_code, r.message, r.text_length) for r in assess.error_rows(results).collect() if r.error_code)
    assert errors == [("bad", 400, "call 1 refused", 3), ("jam", 429, "call 1 refused", 3), ("jam", 429, "call 2 refused", 3), ("slow", 429, "call 1 refused", 4)]
    assert {r.message for r in assess.error_rows(results).collect()} >= {"no answer", "call 1 raised RuntimeError"}
    # every item ends as a result or as an error
    assert results.filter(F.col("response_json").isNull() & (F.size("errors") == 0)).count() == 0


def test_a_worker_gets_the_sent_column_alone_and_hands_answers_on(spark, capsys):
    items = spark.range(0, 6, 1, 1).select(F.col("id").cast("string").alias("post_id"), F.repeat(F.lit("x"), 50).alias("text"), F.lit(50).alias("text_length"))
    items = items.withColumn("prompt", F.concat("post_id", "text"))

    def long_answers():
        return lambda prompt: prompt[0] * 600_000

    calls = assess.call_scorer(items, long_answers, send="prompt")
    # the rows themselves stay in the JVM: no operator takes whole rows to Python
    calls.explain()
    plan = capsys.readouterr().out
    assert "MapIn" not in plan and re.search(r"ArrowEvalPython \[answer\(prompt", plan)
    # 3.6 million characters of answers come in several pieces; rows and answers still belong together
    got = calls.select("post_id", "text_length", F.length("response_json").alias("n"), F.substring("response_json", 1, 1).alias("c"), "attempts").collect()
    assert sorted(tuple(r) for r in got) == [(str(i), 50, 600_000, str(i), 1) for i in range(6)]
    assert calls.filter("response_json is not null").count() == 6 and calls.columns[:4] == items.columns


def test_the_stand_in_remembers_no_text_after_its_retry():
    score = ex.stand_in_toxicity()
    for n in range(1, 400):
        for _ in range(2):
            try:
                score("x" * n)
                break
            except ScorerError:
                pass
    (tried,) = [c.cell_contents for c in score.__closure__ if isinstance(c.cell_contents, set)]
    assert not tried


def test_calls_are_saved_in_batches_and_go_on(spark, folder):
    items = assess.prepare(spark.createDataFrame([(f"t{i}", f"t{i}") for i in range(20)] + [("jam", "jam")], "post_id string, full_conversation string"))
    path = f"{folder}/calls"
    first = assess.continue_calls(items.filter("post_id < 't15'"), path, scripted, batches=3, backoff=0.0)
    n = first.count()
    assert 0 < n < 21
    rest = assess.continue_calls(items, path, scripted, batches=3, backoff=0.0)
    assert rest.count() == 21 and rest.select("post_id").distinct().count() == 21
    assert assess.continue_calls(items, path, scripted, retry_failed=True, backoff=0.0).count() == 22


def test_pace_is_kept_across_tasks(spark):
    items = assess.prepare(spark.createDataFrame([(str(i), f"t{i}") for i in range(8)], "post_id string, full_conversation string"))
    start = time.time()
    rows = assess.call_scorer(items, scripted, tasks=2, pace=0.1).collect()
    assert len(rows) == 8 and time.time() - start >= 0.8


def test_verdicts(spark):
    one = {"user_id": "u", "post_id": "wrong", "comment_id": "c1", "is_flagged": True, "reasoning": "r", "suggested_prompt_modifications": ""}
    answers = {"two": json.dumps([one, {**one, "comment_id": "c2"}]), "empty": "[]", "bare": json.dumps(one), "bad": "[{", "none": None}
    calls = spark.createDataFrame([(k, "p" * 9, 7, v, 1) for k, v in answers.items()], "post_id string, prompt string, text_length int, response_json string, attempts int")
    verdicts = assess.parse_verdicts(calls).collect()
    assert sorted((r.post_id, r.comment_id, r.is_flagged, r.conversation_length) for r in verdicts) == [("two", "c1", True, 7), ("two", "c2", True, 7)]
    assert len({r.gemini_id for r in verdicts}) == 2 and verdicts == assess.parse_verdicts(calls).collect()
    assert {r.post_id for r in assess.verdict_error_rows(calls).collect()} == {"bare", "bad"}
    totals = assess.run_totals(calls).first()
    assert (totals.conversations_analyzed, totals.total_requests) == (4, 5)
    assert totals.total_tokens == 4 * 2 + sum(len(v) // 4 for v in answers.values() if v)


@pytest.mark.parametrize("answer", ['""', "{}", "null", "[1]", '{"attributeScores": {}}', '{"attributeScores": null}', "{bad", "", "[]"])
def test_answers_without_scores_are_errors(spark, answer):
    calls = spark.createDataFrame([("p", "t", 1, answer)], "post_id string, text string, text_length int, response_json string")
    parsed = assess.parse_responses(calls)
    assert assess.flatten_scores(parsed).count() == 0 and assess.ranked_attributes(parsed).count() == 0
    assert [r.details for r in assess.parse_error_rows(parsed).collect()] == [answer]


@pytest.mark.parametrize("answer, good, bad", [
    ("[1,2]", 0, 2), ('["x"]', 0, 1), ('[{"comment_id": "c"}, 5]', 1, 1), ("[null, []]", 0, 2), ("[]", 0, 0), ("null", 0, 1), ('""', 0, 1), ('[{"is_flagged": 3}]', 0, 1), ("[{}]", 1, 0),
])
def test_every_list_element_is_a_verdict_or_an_error(spark, answer, good, bad):
    calls = spark.createDataFrame([("p", "pp", 2, answer)], "post_id string, prompt string, text_length int, response_json string")
    assert (assess.parse_verdicts(calls).count(), assess.verdict_error_rows(calls).count()) == (good, bad)


def test_attribute_without_summary_comes_last(spark):
    answer = json.dumps({"attributeScores": {"THREAT": {"spanScores": []}, "INSULT": score(0.1)}})
    calls = spark.createDataFrame([("p", "t", 1, answer)], "post_id string, text string, text_length int, response_json string")
    row = assess.ranked_attributes(assess.parse_responses(calls)).first()
    assert (row.max_score, row.max_score_attribute, [s.attribute for s in row.scores]) == (0.1, "INSULT", ["INSULT", "THREAT"])


def test_requests_carry_the_contract(spark):
    sent = {}
    assess.toxicity_scorer(lambda request: sent.update(request) or {}, ["toxicity", "Threat"])("hello")
    assert sent["comment"] == {"text": "hello"} and set(sent["requestedAttributes"]) == {"TOXICITY", "THREAT"} and sent["spanAnnotations"]
    assert assess.toxicity_scorer(lambda request: None, [])("x") is None
    got = {}
    judge = assess.verdict_scorer(lambda prompt, **given: got.update(given, prompt=prompt) or "[]", "be fair", {"type": "array"}, max_output_tokens=200)
    assert judge("p") == "[]"
    assert got == {"prompt": "p", "system_instruction": "be fair", "response_schema": {"type": "array"}, "temperature": 0.7, "max_output_tokens": 200, "top_p": 0.95, "top_k": 40}


def test_pace_without_tasks_is_refused(spark):
    items = assess.prepare(spark.createDataFrame([("a", "a")], "post_id string, full_conversation string"))
    with pytest.raises(ValueError, match="tasks"):
        assess.call_scorer(items, scripted, pace=1.1)


def test_the_judge_reads_more_than_the_classifier(spark):
    long = spark.createDataFrame([("a", "x" * 100_000)], "post_id string, full_conversation string")
    assert assess.prepare(long).first().text_length == 19_000
    assert assess.prepare_prompts(long).first().text_length == 100_000
    assert assess.prepare_prompts(long, context_size=50).first().text_length == 50 and assess.prepare(long, context_size=None).first().text_length == 100_000


def test_one_call_per_conversation(spark):
    """Joins of verdicts with their sources evaluate the calls once."""
    from threadwarden.operators import review

    calls = spark.sparkContext.accumulator(0)

    def factory():
        def judge(prompt):
            calls.add(1)
            return json.dumps([{"comment_id": f"c{len(prompt) % 3}", "user_id": "u", "is_flagged": True}])

        return judge

    conversations = spark.createDataFrame([(f"p{i}", "x" * i) for i in range(1, 31)], "post_id string, full_conversation string")
    comments = spark.createDataFrame([("c0", "ann", "b", "p1"), ("c1", "bob", "b", "p2")], "id string, author string, body string, post_id string")
    posts = spark.createDataFrame([(f"p{i}", "t", "ann") for i in range(40)], "id string, title string, author string")
    uses = [
        lambda v: assess.apply_missing_data_rules(v, comments),
        lambda v: assess.fabricated_verdicts(v, comments),
        lambda v: review.verdicts_with_source(v, comments, posts),
    ]
    for n, use in enumerate(uses, 1):
        use(assess.parse_verdicts(assess.judge_conversations(conversations, factory))).collect()
        assert calls.value == 30 * n


def test_a_stopped_run_keeps_the_worst(spark, folder):
    rows = [(f"p{i:02}", f"t{i:02}", 100.0 - i) for i in range(20)]
    items = spark.createDataFrame(rows, "post_id string, text string, max_score double").withColumn("text_length", F.lit(3)).repartition(5)

    def stopping():
        def call(text):
            if text >= "t08":
                raise KeyboardInterrupt
            return "{}"

        return call

    with pytest.raises(Exception):
        assess.continue_calls(items, f"{folder}/calls", stopping, batches=5, order=[F.col("max_score").desc(), "post_id"])
    kept = {r.post_id for r in spark.read.parquet(f"{folder}/calls").collect()}
    assert kept == {f"p{i:02}" for i in range(8)}
    done = assess.continue_calls(items, f"{folder}/calls", scripted, order=[F.col("max_score").desc(), "post_id"], backoff=0.0)
    assert done.count() == 20


def test_other_verdict_schema(spark):
    answer = json.dumps([{"comment_id": "c", "is_spam": True, "severity": 0.5}])
    calls = spark.createDataFrame([("p", "pp", 2, answer)], "post_id string, prompt string, text_length int, response_json string")
    row = assess.parse_verdicts(calls, "is_spam", response_items="struct<comment_id:string,is_spam:boolean,severity:double>").first()
    assert (row.post_id, row.comment_id, row.is_spam, row.severity) == ("p", "c", True, 0.5)


def test_batches_and_resume(spark):
    df = spark.range(23).select(F.col("id").cast("string").alias("post_id"), F.col("id").alias("n"))
    got = assess.batch_slices(df, ["n"], 5, 8).groupBy("batch").agg(F.min("n"), F.max("n")).orderBy("batch").collect()
    assert [tuple(r) for r in got] == [(0, 8, 12), (1, 13, 17), (2, 18, 22)]
    assert assess.not_yet_done(df, df.filter("n < 20")).count() == 3


def test_missing_data_and_fabrication(spark):
    comments = spark.createDataFrame([("c1", "ann", "text", "p"), ("c2", "[deleted]", "text", "p"), ("c3", "bob", "[removed]", "p")], "id string, author string, body string, post_id string")
    verdicts = spark.createDataFrame(
        [(1, "p", "ann", "c1", True), (2, "p", "x", "c2", True), (3, "p", "bob", "c3", True), (4, "p", "eve", "made_up", True), (5, "p", None, None, True), (6, "q", "ann", "c1", True)],
        "n int, post_id string, user_id string, comment_id string, is_flagged boolean",
    )
    ruled = {r.n: (r.user_id, r.comment_id, r.is_flagged) for r in assess.apply_missing_data_rules(verdicts, comments).collect()}
    assert ruled == {1: ("ann", "c1", True), 2: ("N/A", "c2", True), 3: ("bob", "c3", False), 4: ("eve", "N/A", True), 5: ("N/A", "N/A", True), 6: ("ann", "c1", True)}
    assert {r.n for r in assess.fabricated_verdicts(verdicts, comments).collect()} == {4, 6}


def counted(spark, answer=lambda text: "[]"):
    calls = spark.sparkContext.accumulator(0)

    def factory():
        def call(text):
            calls.add(1)
            return answer(text)

        return call

    return calls, factory


def test_every_row_of_one_id_is_called_once(spark, folder):
    """Many rows of one id, some with the same text, and rows without an id: one call each, in any run."""
    rows = [("same", f"t{i % 40}") for i in range(120)] + [(None, "none"), (None, "none"), ("other", "x")]
    items = spark.createDataFrame(rows, "post_id string, text string").withColumn("text_length", F.length("text")).repartition(6)
    calls, factory = counted(spark)
    got = assess.continue_calls(items, f"{folder}/calls", factory, batches=7).collect()
    assert calls.value == len(rows) == len(got)
    assert sorted((str(r.post_id), r.text) for r in got) == sorted((str(p), t) for p, t in rows)
    assert len({(r.post_id, r.copy) for r in got}) == len(rows)
    more = items.unionByName(spark.createDataFrame([("new", "y", 1), (None, "zz", 2)], items.schema))
    assert assess.continue_calls(more, f"{folder}/calls", factory).count() == len(rows) + 2
    assert calls.value == len(rows) + 2


def test_more_batches_than_items(spark, folder):
    items = spark.createDataFrame([(f"p{i}", "t", 1) for i in range(3)], "post_id string, text string, text_length int")
    calls, factory = counted(spark)
    assert assess.continue_calls(items, f"{folder}/calls", factory, batches=10).count() == 3 == calls.value
    assert ledger.commits(spark, f"{folder}/calls") == [0, 1, 2]
    assert assess.continue_calls(items, f"{folder}/calls", factory, batches=10).count() == 3 == calls.value
    assert assess.continue_calls(items.limit(0), f"{folder}/none", factory).count() == 0


def test_new_calls_are_parsed_once(spark, folder):
    parsed = []

    def parse(calls):
        parsed.append(sorted(r.post_id for r in calls.collect()))
        return calls.select("post_id")

    items = spark.createDataFrame([(f"p{i}", "t", 1) for i in range(4)], "post_id string, text string, text_length int")
    calls, factory = counted(spark)
    paths = f"{folder}/calls", f"{folder}/scores"
    assess.continue_calls(items.filter("post_id < 'p2'"), paths[0], factory, batches=2)
    assert assess.parse_new_calls(spark, *paths, parse).count() == 2
    assess.continue_calls(items, paths[0], factory)
    assert assess.parse_new_calls(spark, *paths, parse).count() == 4
    assert assess.parse_new_calls(spark, *paths, parse).count() == 4
    assert parsed == [["p0", "p1"], ["p2", "p3"]]


def stored_bytes(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)


def test_continued_calls_store_each_text_once(spark, folder, monkeypatch):
    """Beside the ledger there is one copy of the texts at most, less with every batch, and nothing at the end."""
    root = f"{folder}/shared"
    monkeypatch.setattr(staging, "stage_root", lambda spark: root)
    rng, seen, commit = random.Random(7), [], ledger.commit
    monkeypatch.setattr(ledger, "commit", lambda df, path, n: seen.append(stored_bytes(root)) or commit(df, path, n))
    letters = [chr(c) for c in range(33, 123)]
    rows = [(f"p{i:03}", "".join(rng.choices(letters, k=20_000))) for i in range(200)]
    items = assess.prepare_prompts(spark.createDataFrame(rows + rows[:80], "post_id string, full_conversation string").repartition(4))
    calls, factory = counted(spark)
    path = f"{folder}/calls"
    assert assess.continue_calls(items, path, factory, send="prompt", batches=4).count() == 280 == calls.value
    texts = 280 * 20_000
    assert len(seen) == 4 and seen[0] < 1.1 * texts and seen[3] < 0.4 * texts
    assert stored_bytes(root) == 0 and spark.conf.get(staging.SHUFFLE_CLEANUP, None) in (None, "false")


def test_temporary_stages_go_when_a_call_fails(spark, folder, monkeypatch):
    monkeypatch.setattr(staging, "stage_root", lambda spark: f"{folder}/shared")
    items = spark.createDataFrame([(f"p{i}", "t", 1) for i in range(4)], "post_id string, text string, text_length int")

    def broken():
        raise KeyboardInterrupt

    with pytest.raises(Exception):
        assess.continue_calls(items, f"{folder}/calls", broken, batches=2)
    assert stored_bytes(f"{folder}/shared") == 0 and not staging._temporary


def test_sent_texts_come_back_as_they_were(spark, folder):
    """Prompts that end with the text, that do not, that are shorter, empty or null."""
    rows = [
        ("a", "text", "say: text"), ("b", "text", "text, it says"), ("c", "long text", "text"), ("d", "", "only this"), ("e", "", ""),
        ("f", None, "no text"), ("g", "no prompt", None), ("h", "\u00e9\U0001f600", "\U0001f600\u00e9\U0001f600"), ("i", "same", "same"), (None, "x", "[None] x"),
    ]
    items = spark.createDataFrame(rows, "post_id string, text string, prompt string").withColumn("text_length", F.length("text"))
    calls, factory = counted(spark, lambda text: json.dumps([text]))
    got = assess.continue_calls(items, f"{folder}/calls", factory, send="prompt", batches=3).collect()
    assert sorted(((r.post_id, r.text, r.prompt) for r in got), key=repr) == sorted(rows, key=repr)
    assert all(json.loads(r.response_json) == [r.prompt] for r in got) and calls.value == len(rows)


def test_copies_are_told_apart_by_the_whole_text_sent(spark, folder):
    """A run that stopped after some rows of one id goes on with the others, in whatever order they come."""
    texts = [f"t{i:02}" for i in range(12)]

    def items(order):
        return assess.prepare_prompts(spark.createDataFrame([("same", t) for t in order], "post_id string, full_conversation string").coalesce(1))

    def stopping():
        def call(prompt):
            if prompt[-3:] not in first:
                raise KeyboardInterrupt
            return "[]"

        return call

    first = set(texts[:4])
    with pytest.raises(Exception):
        assess.continue_calls(items(texts), f"{folder}/calls", stopping, send="prompt", batches=3)
    assert {r.text for r in ledger.read_commits(spark, f"{folder}/calls").collect()} == first
    calls, factory = counted(spark)
    got = assess.continue_calls(items(texts[::-1]), f"{folder}/calls", factory, send="prompt", batches=2).collect()
    assert sorted(r.text for r in got) == texts and calls.value == 8
