"""A Merkle manifest of a dataset whose upper proofs spread by a butterfly exchange.

Every row is a leaf. The leaves of a source, in order of doc_id, are cut into aligned blocks
of ``fanout ** block_levels``; a task hashes a block's subtree by itself. The blocks then meet
in rounds: in each, the blocks below one node of the tree, dealt into groups of one block per
child, swap the roots of the children, and every block hashes the node for itself. So each
block learns its siblings on the way up, and nothing is handed down afterwards. A child with
fewer blocks than its neighbours serves several groups. The same exchange goes on from the
sources' roots to the root of the dataset.

Hashes are SHA-256 over the concatenated lowercase hex digests of the children.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadwarden.operators.distributed import row_position, running_total
from threadwarden.sources.staging import stage

FANOUT = 3
# A block holds fanout ** BLOCK_LEVELS leaves, 2,187: what one task hashes at a time.
BLOCK_LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Layout tables of at most so many nodes are broadcast; their number is known beforehand.
BROADCAST_NODES = 10_000

_BLOCK_SCHEMA = "source string, block bigint, n bigint, root string, doc_ids array<bigint>, leaves binary, claims binary"
_PROOF_SCHEMA = (
    "doc_id bigint, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def leaf_hash(cells: Sequence[Column]) -> Column:
    """Hex digest of the cells, each as byte count, ``:`` and value; a null is ``-``."""
    shown = [F.coalesce(F.concat(F.octet_length(c.cast("string")), F.lit(":"), c.cast("string")), F.lit("-")) for c in cells]
    return F.sha2(F.concat(*shown), 256)


def leaves(docs: DataFrame, claimed_text: Column | None = None) -> DataFrame:
    """(source, doc_id, leaf, claim) of every row; ``claim`` is the leaf with ``claimed_text`` as its text."""
    cells = [F.col(c) for c in COLUMNS]
    leaf = leaf_hash(cells)
    claim = leaf
    if claimed_text is not None:
        claim = F.when(claimed_text.eqNullSafe(F.col("text")), leaf).otherwise(leaf_hash([*cells[:-1], claimed_text]))
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.unhex(leaf).alias("leaf"),
        F.unhex(claim).alias("claim"),
    )


def levels_above(n: int, fanout: int) -> int:
    """Levels from ``n`` nodes to one."""
    levels, width = 0, 1
    while width < n:
        levels, width = levels + 1, width * fanout
    return levels


def _digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def _subtree(nodes: list[bytes], fanout: int, levels: int) -> list[list[bytes]]:
    """The nodes of every level from the leaves to the root of a block."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([_digest(b"".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return found


def _hex_rows(packed: bytes) -> list[bytes]:
    text = packed.hex().encode()
    return [text[i : i + 64] for i in range(0, len(text), 64)]


# ---- blocks ----


def build_blocks(rows: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per block: its root, and its doc_ids, leaves and claims packed in order.

    Leaves ascend by doc_id, null first, then by leaf and claim.
    """
    size = fanout**block_levels
    rows = stage(rows.withColumn("one", F.lit(1)), "leaves")
    placed = running_total(rows, ["doc_id", "leaf", "claim"], F.lit(1), "at", ["source"], {"n": (F.sum, "one")})
    placed = placed.withColumn("block", F.expr(f"at div {size}")).drop("one")

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        n = table.column("n")[0].as_py()
        leaves = b"".join(table.column("leaf").to_pylist())
        root = _subtree(_hex_rows(leaves), fanout, min(block_levels, levels_above(n, fanout)))[-1][0]
        claims = b"".join(table.column("claim").to_pylist())
        return pa.table({
            "source": table.column("source").slice(0, 1),
            "block": table.column("block").slice(0, 1),
            "n": table.column("n").slice(0, 1),
            "root": pa.array([root.decode()]),
            "doc_ids": pa.array([table.column("doc_id").to_pylist()], pa.list_(pa.int64())),
            "leaves": pa.array([leaves], pa.binary()),
            "claims": pa.array([claims], pa.binary()),
        })

    return stage(placed.groupBy("source", "block").applyInArrow(packed, _BLOCK_SCHEMA), "blocks")


# ---- the butterfly ----


def _exchange(state: DataFrame, parent: Sequence[Column], digit: Column, own: Column, serves: Column, width: Column, takes_part: Column) -> DataFrame:
    """One round: every block swaps roots with one block of each sibling and hashes their parent.

    ``own`` numbers the blocks of a child from 0; the child has ``serves`` of them and the
    largest child of the parent ``width``, which is the number of groups. Group ``own`` is
    where a block learns; with its root it also serves ``own + serves``, and so on below
    ``width``. A group has a member per child. Blocks for which ``takes_part`` is false
    keep what they have.
    """
    parent = [*parent, F.when(~takes_part, F.col("block"))]
    names = [f"_parent{i}" for i in range(len(parent))]
    groups = F.sequence(own, F.when(takes_part, width - 1).otherwise(own), F.when(takes_part, serves).otherwise(F.lit(1).cast("bigint")))
    sent = state.select(
        *[p.alias(n) for p, n in zip(parent, names)],
        digit.alias("_digit"),
        takes_part.alias("_takes"),
        own.alias("_own"),
        F.struct(*state.columns).alias("_state"),
        F.explode(groups).alias("_group"),
    )
    member = F.struct(
        F.col("_digit").alias("digit"),
        F.col("_state.top").alias("top"),
        # what a block knows travels only to where it learns
        F.when(F.col("_group") == F.col("_own"), F.col("_state")).alias("state"),
    )
    met = sent.groupBy(*names, "_group").agg(F.array_sort(F.collect_list(member)).alias("_met"), F.first("_takes").alias("_takes"))
    each = met.select("_met", "_takes", F.explode(F.filter("_met", lambda m: m["state"].isNotNull())).alias("_me"))

    def joined(keep) -> Column:
        return F.array_join(F.transform(F.filter("_met", keep), lambda m: m["top"]), "")

    level = F.struct(
        joined(lambda m: m["digit"] < F.col("_me.digit")).alias("left"),
        joined(lambda m: m["digit"] > F.col("_me.digit")).alias("right"),
    )
    takes, known = F.col("_takes"), F.col("_me.state")
    learned = {
        "top": F.when(takes, F.sha2(joined(lambda m: F.lit(True)), 256)).otherwise(known["top"]),
        "path": F.when(takes, F.concat(known["path"], F.array(level))).otherwise(known["path"]),
    }
    return each.select(*[learned.get(c, known[c]).alias(c) for c in state.columns])


def exchange_upwards(blocks: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per block its upper proof: (source, block, path, subroot, root).

    ``path`` has one pair per level above the block: the siblings' digests on the left and
    on the right.
    """
    size = fanout**block_levels
    counts = blocks.groupBy("source").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("blocks"))
    sources = stage(row_position(stage(counts, "sources"), ["source"], "number"), "numbered")
    seen = sources.agg(F.count(F.lit(1)).alias("n"), F.max("blocks").alias("blocks")).first()
    place = sources.select(F.col("source").alias("_source"), "number", "blocks")
    state = blocks.select("source", "block", F.col("root").alias("top")).join(place, F.col("source").eqNullSafe(F.col("_source")))
    empty = F.array().cast("array<struct<left:string,right:string>>")
    state = state.select("source", "number", "block", "blocks", "top", empty.alias("path"), F.lit("").alias("subroot"))

    for r in range(levels_above(seen["blocks"] or 0, fanout)):
        low, high = fanout**r, fanout ** (r + 1)

        def held(node: str, start: int) -> Column:
            # blocks of the child of this width that begins at node * start
            return F.least(F.lit(low).cast("bigint"), F.expr(f"blocks - (block div {node}) * {start}"))

        state = _exchange(
            state,
            [F.col("number"), F.when(F.col("blocks") > low, F.expr(f"block div {high}"))],
            F.expr(f"block div {low} % {fanout}"),
            F.expr(f"block % {low}"),
            held(str(low), low),
            held(str(high), high),
            F.col("blocks") > low,
        )
    state = state.withColumns({"subroot": F.col("top"), "own": F.col("block"), "serves": F.col("blocks")})
    nodes = sources.select(F.col("number").alias("node"), F.col("blocks").alias("serves"))
    for r in range(levels_above(seen["n"], fanout)):
        low, high = fanout**r, fanout ** (r + 1)
        child = F.struct(F.expr(f"node % {fanout}").alias("digit"), F.col("serves").alias("serves"))
        layout = nodes.groupBy(F.expr(f"node div {fanout}").alias("node")).agg(
            F.array_sort(F.collect_list(child)).alias("children"), F.max("serves").alias("width"), F.sum("serves").alias("together")
        )
        few = -(-seen["n"] // high) <= BROADCAST_NODES
        with_layout = state.withColumn("node", F.expr(f"number div {high}")).join(F.broadcast(layout) if few else layout, "node")
        digit = F.expr(f"number div {low} % {fanout}")
        before = F.aggregate(
            F.filter("children", lambda c: c["digit"] < digit), F.lit(0).cast("bigint"), lambda x, c: x + c["serves"]
        )
        with_layout = with_layout.withColumns({"before": before}).drop("children")
        met = _exchange(with_layout, [F.col("node")], digit, F.col("own"), F.col("serves"), F.col("width"), F.lit(True))
        state = met.withColumns({"own": F.col("before") + F.col("own"), "serves": F.col("together")}).drop(
            "node", "width", "together", "before"
        )
        nodes = layout.select("node", F.col("together").alias("serves"))
    return state.select("source", "block", "path", "subroot", F.col("top").alias("root"))


# ---- proofs ----


def prove(blocks: DataFrame, upper: DataFrame, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """Per row its proof's digest, and the root that its claim folds to along the siblings."""

    def proved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                b = batch.slice(row, 1).to_pylist()[0]
                tree = _subtree(_hex_rows(b["leaves"]), fanout, min(block_levels, levels_above(b["n"], fanout)))
                # per level and node, the siblings to the left and to the right
                beside = []
                for nodes in tree[:-1]:
                    sides = []
                    for i in range(len(nodes)):
                        start = i - i % fanout
                        sides.append((b"".join(nodes[start:i]), b"".join(nodes[i + 1 : start + fanout])))
                    beside.append(sides)
                above = [(p["left"].encode(), p["right"].encode()) for p in b["path"]]
                upper_proof = b"".join(left + right for left, right in above)
                proofs, folded = [], []
                for i, claim in enumerate(_hex_rows(b["claims"])):
                    proof, at = [], i
                    for sides in beside:
                        left, right = sides[at]
                        proof += [left, right]
                        claim = _digest(left + claim + right)
                        at //= fanout
                    for left, right in above:
                        claim = _digest(left + claim + right)
                    proofs.append(hashlib.sha256(b"".join(proof) + upper_proof).hexdigest())
                    folded.append(claim.decode())
                n = len(folded)
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(b["doc_ids"], pa.int64()),
                        "source": pa.array([b["source"]] * n, pa.string()),
                        "leaf": pa.array([x.decode() for x in tree[0]]),
                        "subroot": pa.array([b["subroot"]] * n),
                        "root": pa.array([b["root"]] * n),
                        "proof_sha256": pa.array(proofs),
                        "folded_root": pa.array(folded),
                        "verified": pa.array([x == b["root"] for x in folded]),
                    }
                )

    learned = upper.select(F.col("source").alias("_source"), F.col("block").alias("_block"), "path", "subroot", F.col("root").alias("_root"))
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    both = blocks.drop("root").join(learned, same).drop("_source", "_block").withColumnRenamed("_root", "root")
    return both.mapInArrow(proved, _PROOF_SCHEMA)


def manifest(
    docs: DataFrame, claimed_text: Column | None = None, fanout: int = FANOUT, block_levels: int = BLOCK_LEVELS
) -> DataFrame:
    """The manifest of ``docs``: one row per row with its leaf, the roots and its proof.

    A leaf hashes doc_id, source, lang, n_chars and the whole text; a null cell is a mark of its
    own, unlike an empty text. Other columns are not read. Rows without a source form a
    tree of their own, the first one; rows without a doc_id are a source's first leaves; rows
    repeated in every cell are leaves each. ``claimed_text`` is what is checked in place of
    the text: ``folded_root`` and ``verified`` tell whether it stands the proof. An empty table
    gives an empty manifest.
    """
    blocks = build_blocks(leaves(docs, claimed_text), fanout, block_levels)
    return prove(blocks, stage(exchange_upwards(blocks, fanout, block_levels), "upper"), fanout, block_levels)
