"""Reply trees formatted as conversations for training.

Messages answer messages. Repeated self-joins give every message its root: each round, a
message takes over what its current ancestor knows, so depth d needs log2(d) rounds. Leaves
are ranked by the mean score of their path, the chosen leaves gather their ancestors by the
same jumps, and each path from root to leaf becomes one text with a loss mask.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadwarden.llm.common import first_of_repeats
from threadwarden.operators.distributed import ranked_top_n, row_position, running_total
from threadwarden.sources.staging import read_stages, stage, write_stage

# Template: <s>role, a line break, the text (between [INST] and [/INST] for users), </s>.
TURN, END = "<s>", "</s>"
ASK, ASKED = "[INST] ", " [/INST]"
USER, TRAINED = "user", "assistant"
# Characters of a path that are stored in one row, about: whole turns that begin in them.
PART_CHARS = 1 << 18


# ---- one text ----


def escape(text: str) -> str:
    """Puts one backslash more into whatever reads like a control string."""
    return re.sub(r"([<\[])(\\*/?(?:s>|INST\]))", r"\1\\\2", text)


def unescape(text: str) -> str:
    return re.sub(r"([<\[])\\(\\*/?(?:s>|INST\]))", r"\1\2", text)


def format_turns(turns: Sequence[tuple[str, str]], trained: str = TRAINED) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text) turns, and the places of the trained role's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
        before, behind = (ASK, ASKED) if role == USER else ("", "")
        head, body = f"{TURN}{name}\n{before}", escape(text)
        if role == trained:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, behind, END]
        at += len(head) + len(body) + len(behind) + len(END)
    return "".join(parts), spans


def parse_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns that :func:`format_turns` was given."""
    turns = []
    for part in formatted.split(END)[:-1]:
        name, _, body = part[len(TURN) :].partition("\n")
        role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name))
        if role == USER:
            body = body[len(ASK) : len(body) - len(ASKED)]
        turns.append((role, unescape(body)))
    return turns


# ---- trees ----


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree_id, leaf_id, rank, path_score, node_id, depth) of the best paths' messages.

    ``messages`` has tree_id, node_id, parent_id and score; depth counts from 1 at the root. A
    message whose parent is null or missing is a root. The score of a path is the mean of its
    messages' (null counts as 0); ties go to the longer path, then to the smaller leaf_id.
    Messages on or below a circle of replies have no root and are left out.
    """
    nodes = stage(messages.select("tree_id", "node_id", "parent_id", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")), "nodes")
    known = nodes.select("tree_id", F.col("node_id").alias("parent_id"), F.lit(True).alias("found"))
    total = nodes.count()
    state = nodes.join(known, ["tree_id", "parent_id"], "left").select(
        "tree_id", "node_id", F.when(F.col("found"), F.col("parent_id")).alias("above"), F.lit(1).cast("bigint").alias("depth"), F.col("score").alias("total")
    )
    open_ = F.count("above")
    path, seen = write_stage(state, "jumps", open=open_)
    jumps = [path]
    # only messages that have not met their root go on; whoever has none after more steps than
    # there are messages is in a circle
    while seen["open"] and 1 << (len(jumps) - 1) <= total:
        waiting = read_stages(state, jumps[-1]).filter("above is not null")
        known = read_stages(state, *jumps).filter("above is null").unionByName(waiting)
        up = known.select("tree_id", F.col("node_id").alias("above"), F.col("above").alias("next"), F.col("depth").alias("more"), F.col("total").alias("gain"))
        step = waiting.join(up, ["tree_id", "above"]).select(
            "tree_id", "node_id", F.col("next").alias("above"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("total") + F.col("gain")).alias("total")
        )
        path, seen = write_stage(step, "jumps", open=open_)
        jumps.append(path)
    done = read_stages(state, *jumps).filter("above is null")
    parents = nodes.filter("parent_id is not null").select("tree_id", F.col("parent_id").alias("node_id")).distinct()
    leaves = done.join(parents, ["tree_id", "node_id"], "left_anti").withColumn("path_score", F.col("total") / F.col("depth"))
    order = [F.col("path_score").desc(), F.col("depth").desc(), F.col("node_id")]
    chosen = ranked_top_n(leaves, ["tree_id"], order, branches, "rank")
    chosen = chosen.select("tree_id", F.col("node_id").alias("leaf_id"), "rank", "path_score", "node_id")
    # ancestors at every distance: far jumps first, then ever nearer ones; each jump is written
    # once, so that the plan does not double with it
    paths = [write_stage(chosen, "members")[0]]
    for jump in reversed(jumps[:-1]):
        up = read_stages(state, jump).filter("above is not null").select("tree_id", "node_id", "above")
        higher = read_stages(chosen, *paths).join(up, ["tree_id", "node_id"])
        higher = higher.select("tree_id", "leaf_id", "rank", "path_score", F.col("above").alias("node_id"))
        paths.append(write_stage(higher, "members")[0])
    chosen = read_stages(chosen, *paths)
    return chosen.join(done.select("tree_id", "node_id", "depth"), ["tree_id", "node_id"])


def format_trees(messages: DataFrame, branches: int = 1, trained: str = TRAINED) -> DataFrame:
    """The chosen paths: tree_id, leaf_id, rank, path_score, part, start, formatted and loss_spans.

    ``messages``: tree_id, node_id, parent_id, role, text, score. Null roles and texts count
    as empty. Of rows repeated under one tree_id and node_id one counts, whichever; rows
    without either id are left out. A path is one row, part 0, up to about PART_CHARS
    characters; longer ones are several rows of whole turns, whose texts in order of part are
    the text of the path. start is the place of the part in it. loss_spans are [begin, end) in
    code points of the part, one for each text of the ``trained`` role. An empty table gives no
    rows; other columns are not read.
    """
    messages = messages.select("tree_id", "node_id", "parent_id", "role", "text", "score").filter("tree_id is not null and node_id is not null")
    messages = first_of_repeats(stage(messages, "messages"), ["tree_id", "node_id"])
    paths = best_paths(messages, branches)
    texts = messages.select("tree_id", "node_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.join(texts, ["tree_id", "node_id"]).select("tree_id", "leaf_id", "rank", "path_score", "depth", "role", "text")

    def formatted(batches):
        for batch in batches:
            out = [format_turns([turn], trained) for turn in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist())]
            begin, end = ([spans[0][k] if spans else None for _, spans in out] for k in (0, 1))
            columns = [pa.array([t for t, _ in out], pa.string()), pa.array([len(t) for t, _ in out], pa.int64())]
            columns += [pa.array(x, pa.int64()) for x in (begin, end)]
            rest = batch.drop_columns(["role", "text"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *columns], [*rest.schema.names, "formatted", "chars", "begin", "end"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in turns.schema if f.name not in ("role", "text"))
    turns = stage(turns.mapInArrow(formatted, f"{schema}, formatted string, chars bigint, begin bigint, end bigint"), "turns")
    path = ["tree_id", "leaf_id"]
    placed = running_total(turns.select(*path, "depth", "chars"), ["depth"], F.col("chars"), "at", path, null_groups=False)
    placed = turns.join(placed.select(*path, "depth", "at"), [*path, "depth"]).withColumn("part", F.floor(F.col("at") / PART_CHARS))
    parts = placed.groupBy(*path, "rank", "path_score", "part").agg(
        F.min("at").alias("start"), F.sort_array(F.collect_list(F.struct("depth", "at", "formatted", "begin", "end"))).alias("turns")
    )
    spans = F.transform(
        F.filter("turns", lambda t: t["begin"].isNotNull()),
        lambda t: F.struct(*[(t["at"] - F.col("start") + t[c]).cast("int").alias(c) for c in ("begin", "end")]),
    )
    whole = F.array_join(F.col("turns.formatted"), "")
    return parts.select(*path, "rank", "path_score", "part", "start", whole.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """tree_id with digests of what the formatted texts hold, see the columns below.

    The parts of a path come sorted and are digested one after the other; none waits for the next.
    """

    def read(batches):
        path = None
        for batch in batches:
            rows = []
            for tree_id, leaf_id, text, spans in zip(*(batch.column(c).to_pylist() for c in ("tree_id", "leaf_id", "formatted", "loss_spans"))):
                if path != (tree_id, leaf_id):
                    if path is not None:
                        rows.append((path[0], *digests()))
                    path, n_turns, loss_chars, chars, of_turns, of_loss = (tree_id, leaf_id), 0, 0, 0, hashlib.sha256(), hashlib.sha256()
                digests = lambda: (n_turns, of_turns.hexdigest(), loss_chars, of_loss.hexdigest(), chars)
                for role, body in parse_turns(text):
                    n_turns += 1
                    of_turns.update(f"{role}\n{body}\n".encode())
                for span in spans:
                    loss = unescape(text[span["begin"] : span["end"]])
                    loss_chars += len(loss)
                    of_loss.update(loss.encode())
                chars += len(text)
            yield table(rows, batch.schema.field("tree_id").type)
            kind_of_id = batch.schema.field("tree_id").type
        if path is not None:
            yield table([(path[0], *digests())], kind_of_id)

    def table(rows, kind_of_id):
        kinds = (kind_of_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        names = ["tree_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)], names)

    kind = formatted.schema["tree_id"].dataType.simpleString()
    schema = f"tree_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    parts = formatted.select("tree_id", "leaf_id", "part", "formatted", "loss_spans").repartition("tree_id", "leaf_id")
    parts = parts.sortWithinPartitions("tree_id", "leaf_id", "part")
    return parts.select("tree_id", "leaf_id", "formatted", "loss_spans").mapInArrow(read, schema)


def conversation_trees(conversations: DataFrame) -> DataFrame:
    """Rows of (conv_id, turn, role, text) as messages that each answer the one before.

    Rows are ordered by turn, null first, then by role and text. tree_id is conv_id as text,
    empty for null. The running position needs no conversation to lie in one task.
    """
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree_id"), "turn", F.col("role").cast("string"), F.col("text").cast("string")
    )
    placed = row_position(rows, ["turn", "role", "text"], "node_id", ["tree_id"])
    return placed.select(
        "tree_id", "node_id", F.when(F.col("node_id") > 0, F.col("node_id") - 1).alias("parent_id"), "role", "text", F.lit(0.0).alias("score")
    )
