"""Model assessment of conversation texts: prepare, call a pluggable scorer, parse.

Only ``call_scorer`` leaves the JVM, and only to run the user's client. Everything before
and after it is column expressions.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadwarden import schemas
from threadwarden.functions.scores import best_span
from threadwarden.functions.text import CONTEXT_LIMIT, JUDGE_LIMIT, prompt, stable_id, token_estimate, truncated
from threadwarden.operators.distributed import move_rows, row_position, store_rows
from threadwarden.sources import ledger
from threadwarden.sources.staging import drop, new_stage_path, read_stages, stage, temporary_stages

# Seconds before the one retry after a 429, rows per batch, and the sheet name
# stamped on conversation results.
RETRY_WAIT = 10.0
MAX_RETRIES = 1
BATCH_SIZE = 50
SHEET_NAME = "conversations"
# Answers leave a Python worker when so many characters, or rows, have come together.
ANSWER_CHARS = 1_000_000
ANSWER_ROWS = 500
# ``schemas.SCORER_OUTPUT`` as Arrow holds it.
_ERROR = pa.struct({"at": pa.timestamp("us", "UTC"), "error_code": pa.int32(), "message": pa.string(), "details": pa.string()})
_ANSWER = pa.struct({"response_json": pa.string(), "attempts": pa.int32(), "errors": pa.list_(_ERROR)})
# The sampling parameters of a generate call.
GENERATE_PARAMS = {"temperature": 0.7, "max_output_tokens": 500, "top_p": 0.95, "top_k": 40}


class ScorerError(Exception):
    """A failed call with its HTTP-like status, raised by scorers."""

    def __init__(self, status: int, reason: str = ""):
        super().__init__(reason)
        self.status = status
        self.reason = reason


# A factory runs once per task that has rows and returns the call: text in, response JSON (or None) out.
ScorerFactory = Callable[[], Callable[[str], str | None]]


def toxicity_scorer(analyze: Callable[[dict], dict], attributes: Sequence[str], spans: bool = True):
    """A scorer that sends each text with the requested attributes to ``analyze``."""
    wanted = {a.upper(): {"scoreType": "PROBABILITY"} for a in attributes}

    def score(text: str) -> str | None:
        answer = analyze({"comment": {"text": text}, "spanAnnotations": spans, "requestedAttributes": wanted})
        return None if answer is None else json.dumps(answer)

    return score


def verdict_scorer(generate: Callable[..., str], system_instruction: str, response_schema: dict, **params):
    """A scorer that sends each prompt with instruction, schema and sampling parameters."""
    settings = {**GENERATE_PARAMS, **params}

    def judge(text: str) -> str | None:
        return generate(text, system_instruction=system_instruction, response_schema=response_schema, **settings)

    return judge


def prepare(
    conversations: DataFrame, text: str = "full_conversation", context_size: int | None = CONTEXT_LIMIT
) -> DataFrame:
    """Rows with a text, cut to the model's limit (None: whole): post_id, subreddit if known, text, text_length."""
    kept = [c for c in ("post_id", "subreddit") if c in conversations.columns]
    return (
        conversations.filter(F.col(text).isNotNull())
        .select(*kept, truncated(F.col(text), context_size).alias("text"))
        .withColumn("text_length", F.length("text"))
    )


def prepare_prompts(
    conversations: DataFrame, text: str = "full_conversation", context_size: int | None = JUDGE_LIMIT
) -> DataFrame:
    """As ``prepare``, with the prompt that names the post and the language model's larger limit."""
    return prepare(conversations, text, context_size).withColumn("prompt", prompt(F.col("post_id"), F.col("text")))


def call_scorer(
    items: DataFrame,
    factory: ScorerFactory,
    send: str = "text",
    tasks: int | None = None,
    pace: float = 0.0,
    max_retries: int = MAX_RETRIES,
    backoff: float = RETRY_WAIT,
) -> DataFrame:
    """Send column ``send`` of each row to the scorer; adds response_json, attempts, errors.

    With ``tasks`` the rows are spread over that many tasks, each waiting ``pace * tasks``
    seconds between calls, so that together they keep one call per ``pace``; a pace without
    ``tasks`` would hold for each task alone and is refused. A 429 is
    retried ``max_retries`` times after ``backoff`` seconds; any other failure is not.
    Every failure is an element of ``errors``; nothing is lost silently.

    Only column ``send`` goes to Python, and answers come back a few at a time, so a worker holds
    one Arrow batch of texts and never the rows of its task.

    Save the result before using it more than once: each use of the lazy result, and each
    task that is run again, repeats its calls.
    """
    if pace and not tasks:
        raise ValueError("pace needs tasks: the rate is kept by so many tasks together")
    wait = pace * tasks if tasks else 0.0
    spread = items.repartition(tasks) if tasks else items
    outcome = T.StructType.fromDDL(schemas.SCORER_OUTPUT)

    @F.arrow_udf(outcome)
    def answer(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        call = None
        for column in columns:
            answers, size = [], 0
            for value in column:
                call = call or factory()
                answers.append(_attempt(call, value.as_py(), wait, max_retries, backoff))
                size += _answer_chars(answers[-1])
                if size >= ANSWER_CHARS or len(answers) >= ANSWER_ROWS:
                    yield pa.array(answers, _ANSWER)
                    answers, size = [], 0
            if answers:
                yield pa.array(answers, _ANSWER)

    # nondeterministic: no plan may move a filter below the calls or repeat them per field
    answered = spread.withColumn("_answer", answer.asNondeterministic()(F.col(send)))
    return answered.select(*items.columns, *[F.col(f"_answer.{n}") for n in outcome.names])


def _answer_chars(answer: dict) -> int:
    return len(answer["response_json"] or "") + sum(len(e["details"]) for e in answer["errors"])


def _attempt(call, value: str, wait: float, max_retries: int, backoff: float) -> dict:
    errors: list[dict] = []
    for attempt in range(1, max_retries + 2):
        try:
            response = call(value)
        except ScorerError as e:
            errors.append(_error(e.status, f"call {attempt} refused", e.reason))
            if e.status != 429 or attempt > max_retries:
                break
            time.sleep(backoff)
        except Exception as e:
            errors.append(_error(None, f"call {attempt} raised {type(e).__name__}", str(e)))
            break
        else:
            if response is None:
                errors.append(_error(None, "no answer", "the model returned nothing"))
            time.sleep(wait)
            return {"response_json": response, "attempts": attempt, "errors": errors}
    return {"response_json": None, "attempts": attempt, "errors": errors}


def _error(code: int | None, message: str, details: str) -> dict:
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    return {"at": now, "error_code": code, "message": message, "details": details}


def error_rows(calls: DataFrame) -> DataFrame:
    """One row per failed call: (at, post_id, text_length, error_code, message, details)."""
    return calls.select("post_id", "text_length", F.explode("errors").alias("error")).select(
        "error.at", "post_id", "text_length", "error.error_code", "error.message", "error.details"
    )


def parse_responses(calls: DataFrame) -> DataFrame:
    """Calls with the classifier response as ``response``; its _corrupt_record marks broken JSON."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    return calls.withColumn("response", F.from_json("response_json", schemas.TOXICITY_RESPONSE, options))


def flatten_scores(
    parsed: DataFrame, attributes: Sequence[str] = schemas.ATTRIBUTES, sheet_name: str = SHEET_NAME
) -> DataFrame:
    """Wide score rows: per attribute its summary score and the best span's begin and end.

    Broken, empty or absent responses give no row but an error row; absent attributes, spans
    or languages give null.
    """
    usable = parsed.filter(_usable())
    scored: list[Column] = []
    for name in (a.lower() for a in attributes):
        entry = F.element_at("response.attributeScores", F.lit(name.upper()))
        span = best_span(entry["spanScores"])
        scored += [
            entry["summaryScore"]["value"].alias(f"{name}_score"),
            span["begin"].cast("double").alias(f"{name}_max_span_begin"),
            span["end"].cast("double").alias(f"{name}_max_span_end"),
        ]
    return usable.select(
        stable_id(F.lit(sheet_name), F.col("post_id")).alias("perspective_id"),
        F.lit(sheet_name).alias("sheet_name"),
        (F.col("subreddit") if "subreddit" in parsed.columns else F.lit(None).cast("string")).alias("subreddit"),
        "post_id",
        F.array_join("response.languages", " ").alias("languages"),
        F.array_join("response.detectedLanguages", " ").alias("detected_languages"),
        *scored,
    )


def _usable() -> Column:
    """True for a response that scores at least one attribute, never null."""
    scored = F.size("response.attributeScores") > 0
    return F.col("response_json").isNotNull() & F.col("response._corrupt_record").isNull() & F.coalesce(scored, F.lit(False))


def parse_error_rows(parsed: DataFrame) -> DataFrame:
    """Responses that came but hold no scores, in the shape of ``error_rows`` without a time."""
    broken = F.col("response._corrupt_record").isNotNull()
    return parsed.filter(F.col("response_json").isNotNull() & ~_usable()).select(
        F.lit(None).cast("timestamp").alias("at"),
        "post_id",
        "text_length",
        F.lit(None).cast("int").alias("error_code"),
        F.when(broken, "JSONDecodeError").otherwise("no scores").alias("message"),
        F.col("response_json").alias("details"),
    )


def ranked_attributes(parsed: DataFrame) -> DataFrame:
    """Per response its attributes by falling score, each with the texts of its spans.

    Columns: post_id, max_score, max_score_attribute, scores, languages, detected_languages.
    Attributes of equal score keep the order of the response.
    """

    def span_text(span: Column) -> Column:
        cut = F.col("text").substr(span["begin"] + 1, span["end"] - span["begin"])
        return F.struct(cut.alias("text"), span["score"]["value"].alias("score"))

    # the position stands in front of the attribute, so that sorting by the struct settles ties
    entries = F.transform(
        F.map_entries("response.attributeScores"),
        lambda e, i: F.struct(
            # an attribute without a summary score comes last
            F.coalesce(-e["value"]["summaryScore"]["value"], F.lit(float("inf"))).alias("falling"),
            i.alias("position"),
            e["key"].alias("attribute"),
            e["value"]["summaryScore"]["value"].alias("summary_score"),
            F.transform(e["value"]["spanScores"], span_text).alias("spans"),
        ),
    )
    scores = F.transform(
        F.array_sort(entries),
        lambda e: F.struct(
            e["attribute"].alias("attribute"), e["summary_score"].alias("summary_score"), e["spans"].alias("spans")
        ),
    )
    ranked = parsed.filter(_usable()).withColumn("scores", scores)
    top = F.get("scores", F.lit(0))
    return ranked.select(
        "post_id",
        top["summary_score"].alias("max_score"),
        top["attribute"].alias("max_score_attribute"),
        "scores",
        F.col("response.languages").alias("languages"),
        F.col("response.detectedLanguages").alias("detected_languages"),
    )


def parse_verdicts(
    calls: DataFrame, verdict_col: str = "is_flagged", sheet_name: str = SHEET_NAME, response_items: str | None = None
) -> DataFrame:
    """One row per verdict of a non-empty JSON list; the true post id replaces the model's.

    ``response_items`` may give the DDL of a verdict read from a response schema file.
    """
    item = response_items or schemas.verdict_type(verdict_col).simpleString()
    verdicts = _elements(calls, item).filter(F.col("verdict").isNotNull()).select(
        "post_id",
        F.col("text_length").cast("long").alias("conversation_length"),
        token_estimate(F.col("prompt"), F.col("response_json")).alias("tokens_used"),
        "position",
        "verdict",
    )
    names = [f.name for f in T.StructType.fromDDL(item).fields if f.name != "post_id"]
    stamped = verdicts.select(
        "post_id",
        *[F.col(f"verdict.{n}").alias(n) for n in names],
        stable_id(F.lit(sheet_name), F.col("post_id"), F.col("position")).alias("gemini_id"),
        F.lit(sheet_name).alias("sheet_name"),
        "conversation_length",
        "tokens_used",
    )
    wanted = [c for c in schemas.verdicts_schema(verdict_col).names if c in stamped.columns]
    return stamped.select(*wanted, *[c for c in stamped.columns if c not in wanted])


def _elements(calls: DataFrame, item: str) -> DataFrame:
    """Each element of a response list by itself: ``verdict`` is null if it is no such record."""
    listed = calls.filter(F.json_array_length("response_json") > 0)
    texts = F.from_json("response_json", "array<string>")
    each = listed.select("*", F.posexplode(texts).alias("position", "element"))
    inner = f"struct<{item[len('struct<') : -1]},_corrupt_record:string>"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    parsed = each.withColumn("found", F.from_json("element", inner, options))
    good = F.col("element").rlike(r"^\s*\{") & F.col("found").isNotNull() & F.col("found._corrupt_record").isNull()
    return parsed.withColumn("verdict", F.when(good, F.col("found"))).drop("found")


def verdict_error_rows(
    calls: DataFrame, verdict_col: str = "is_flagged", response_items: str | None = None
) -> DataFrame:
    """Responses that are no JSON list, and list elements that are no verdicts, in the shape of
    ``error_rows`` without a time. So every answer ends in verdicts, errors or an empty list."""
    readable = F.coalesce(F.json_array_length("response_json") >= 0, F.lit(False))
    item = response_items or schemas.verdict_type(verdict_col).simpleString()

    def shaped(rows: DataFrame, message: str, details: str) -> DataFrame:
        return rows.select(
            F.lit(None).cast("timestamp").alias("at"),
            "post_id",
            "text_length",
            F.lit(None).cast("int").alias("error_code"),
            F.lit(message).alias("message"),
            F.col(details).alias("details"),
        )

    lists = shaped(calls.filter(F.col("response_json").isNotNull() & ~readable), "JSONDecodeError", "response_json")
    bad = _elements(calls, item).filter(F.col("verdict").isNull())
    return lists.unionByName(shaped(bad, "no verdict", "element"))


def run_totals(calls: DataFrame) -> DataFrame:
    """Conversations answered, requests sent and tokens estimated."""
    answered = F.col("response_json").isNotNull()
    sent = F.col("prompt") if "prompt" in calls.columns else F.col("text")
    return calls.agg(
        F.count(F.when(answered, 1)).alias("conversations_analyzed"),
        F.coalesce(F.sum(F.when(answered, token_estimate(sent, F.col("response_json")))), F.lit(0)).alias("total_tokens"),
        F.coalesce(F.sum("attempts"), F.lit(0)).alias("total_requests"),
    )


def batch_slices(
    df: DataFrame, order: Sequence[Column | str], batch_size: int = BATCH_SIZE, start_row: int = 0
) -> DataFrame:
    """Rows from ``start_row`` on with their position and batch number."""
    placed = row_position(df, order, "position").filter(F.col("position") >= start_row)
    return placed.withColumn("batch", F.floor((F.col("position") - start_row) / batch_size))


def not_yet_done(items: DataFrame, done: DataFrame, key: str = "post_id") -> DataFrame:
    """Items without a saved result: the way to resume."""
    return items.join(done.select(key).distinct(), key, "left_anti")


# Stand-ins of deleted authors and removed texts, and what verdicts say then.
DELETED = ("[deleted]", "[removed]")
NOT_AVAILABLE = "N/A"


def apply_missing_data_rules(verdicts: DataFrame, comments: DataFrame, verdict_col: str = "is_flagged") -> DataFrame:
    """Ids that are missing or deleted become N/A; a removed text is never flagged."""
    source = comments.select(
        F.col("id").alias("comment_id"), F.col("author").alias("_author"), F.col("body").alias("_body")
    ).withColumn("_found", F.lit(True))
    joined = verdicts.join(source, "comment_id", "left")
    no_author = F.col("user_id").isNull() | F.col("_author").isin(*DELETED) | F.col("user_id").isin("", *DELETED)
    no_comment = F.col("comment_id").isNull() | F.col("_found").isNull()
    return joined.withColumns({
        "user_id": F.when(no_author, NOT_AVAILABLE).otherwise(F.col("user_id")),
        "comment_id": F.when(no_comment, NOT_AVAILABLE).otherwise(F.col("comment_id")),
        verdict_col: F.when(F.col("_body").isin(*DELETED), F.lit(False)).otherwise(F.col(verdict_col)),
    }).select(*verdicts.columns)


def fabricated_verdicts(verdicts: DataFrame, members: DataFrame) -> DataFrame:
    """Verdicts on comments that their thread does not hold.

    ``members`` has post_id and id, as ``link_comments`` returns. A verdict on the post
    itself names no comment (null or N/A) and is not a violation.
    """
    named = verdicts.filter(F.col("comment_id").isNotNull() & (F.col("comment_id") != NOT_AVAILABLE))
    known = members.select("post_id", F.col("id").alias("comment_id"))
    return named.join(known, ["post_id", "comment_id"], "left_anti").select(*verdicts.columns)


def score_conversations(
    conversations: DataFrame,
    factory: ScorerFactory,
    attributes: Sequence[str] = schemas.ATTRIBUTES,
    context_size: int | None = CONTEXT_LIMIT,
    **call_options,
) -> DataFrame:
    """Toxicity calls of a conversations table, parsed: feed to flatten_scores, error_rows."""
    return parse_responses(call_scorer(prepare(conversations, context_size=context_size), factory, **call_options))


def judge_conversations(
    conversations: DataFrame, factory: ScorerFactory, context_size: int | None = JUDGE_LIMIT, **call_options
) -> DataFrame:
    """Verdict calls of a conversations table: feed to parse_verdicts, error_rows, run_totals."""
    return call_scorer(prepare_prompts(conversations, context_size=context_size), factory, send="prompt", **call_options)


def continue_calls(
    items: DataFrame,
    path: str,
    factory: ScorerFactory,
    send: str = "text",
    retry_failed: bool = False,
    batches: int | None = None,
    order: Sequence[Column | str] = ("post_id",),
    **call_options,
) -> DataFrame:
    """Call the scorer for the items not yet in the ledger at ``path``; returns all calls so far.

    Every item row is answered once: rows of one post_id, null too, are told apart by ``copy``,
    their number in order of the text sent, and ledger rows carry both. The items are stored once,
    then moved, those that are open, to batches by ``order`` (whose columns the items must have;
    worst first, so that a quota cuts the least toxic), and each batch is a commit: a run that
    stopped goes on where it ended and loses one batch at most. Without ``batches`` a batch holds
    BATCH_SIZE items, or a hundredth of them if that is more. With ``retry_failed`` items that so
    far have only errors are sent again, which adds rows to theirs.

    Texts are not shuffled here, and besides the ledger there is one stored copy of each: what has been
    moved is deleted, and so is a batch that has been committed.
    """
    spark = items.sparkSession
    kept = [c for c in items.columns if c != "max_score"]
    ranked = [c for c in ("max_score",) if c in items.columns]
    with temporary_stages(spark):
        rows = store_rows(_folded(items.withColumn("_text", F.xxhash64(send)), send))
        keys = _numbered_copies(rows.select("_row", "post_id", "_text", *ranked))
        if ledger.commits(spark, path):
            done = ledger.read_commits(spark, path)
            done = done.filter(F.col("response_json").isNotNull()) if retry_failed else done
            done = done.select(F.col("post_id").alias("_post"), F.col("copy").alias("_copy")).distinct()
            keys = keys.join(done, F.col("post_id").eqNullSafe(F.col("_post")) & (F.col("copy") == F.col("_copy")), "left_anti")
        keys = stage(keys.drop("_text"), "open_items")
        placed = stage(row_position(keys, [*order, "_row"], "position").select("_row", "copy", "position"), "positions")
        n = placed.count()
        batches = min(n, min(100, -(-n // BATCH_SIZE)) if batches is None else max(1, batches))
        first = ledger.next_commit(spark, path)
        rows = rows.drop("_text", *ranked)
        like = rows.drop("_row").withColumn("copy", F.lit(0).cast("long"))

        def answered(stored: DataFrame) -> DataFrame:
            return call_scorer(_unfolded(stored, send).select(*kept, "copy"), factory, send, **call_options)

        if not n and not first:
            ledger.commit(answered(like), path, 0)
        elif n:
            folder = new_stage_path(spark, "batches")
            move_rows(rows, placed.select("_row", "copy", F.expr(f"position * {batches} div {n}").alias("batch")), folder, "batch")
            for number in range(batches):
                ledger.commit(answered(read_stages(like, f"{folder}/batch={number}")), path, first + number)
                drop(spark, f"{folder}/batch={number}")
    return ledger.read_commits(spark, path)


def _folded(items: DataFrame, send: str) -> DataFrame:
    """``items`` with a sent text that ends with column ``text`` cut down to what stands before that.

    A prompt is mostly the text beside it, which would be stored twice. Column ``_folded`` marks
    the rows that ``_unfolded`` has to put together; joined again they gave the very text.
    """
    types = dict(items.dtypes)
    if send == "text" or types.get("text") != "string" or types[send] != "string":
        return items
    head = F.substring(send, F.lit(1), F.length(send) - F.length("text"))
    same = F.coalesce(F.concat(head, "text") == F.col(send), F.lit(False))
    return items.withColumns({"_folded": same, send: F.when(same, head).otherwise(F.col(send))})


def _unfolded(rows: DataFrame, send: str) -> DataFrame:
    if "_folded" not in rows.columns:
        return rows
    return rows.withColumn(send, F.when(F.col("_folded"), F.concat(send, "text")).otherwise(F.col(send)))


def _numbered_copies(keys: DataFrame) -> DataFrame:
    """Stored ``keys`` with the number of each row among those of its post_id."""
    if keys.groupBy("post_id").count().filter("count > 1").isEmpty():
        return keys.withColumn("copy", F.lit(0).cast("long"))
    return row_position(keys, ["_text", "_row"], "copy", ["post_id"])


def parse_new_calls(spark: SparkSession, calls_path: str, path: str, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Append what ``parse`` makes of the commits of calls that the ledger at ``path`` has not seen.

    The commit bears the number of the last commit of calls in it, so earlier ones are never
    parsed again, and a repeated run adds nothing.
    """
    seen = max(ledger.commits(spark, path), default=-1)
    new = [n for n in ledger.commits(spark, calls_path) if n > seen]
    if new:
        ledger.commit(parse(ledger.read_commits(spark, calls_path, new)), path, new[-1])
    return ledger.read_commits(spark, path)
