import hashlib
import random

import pytest
from pyspark.sql import functions as F

from threadwarden.llm import merkle_manifest as mm

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf int, block int, root string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def cell(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes, fanout):
    """Root, and per node the siblings (left, right) of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, path in enumerate(paths):
            begin = at[i] - at[i] % fanout
            path.append((nodes[begin : at[i]], nodes[at[i] + 1 : begin + fanout]))
            at[i] //= fanout
        nodes = [h(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], paths


def brute_force(rows, fanout=3):
    by_source = {}
    for r in rows:
        leaf = h(*[cell(x) for x in (r[0], r[1], r[2], r[3], r[4])])
        claim = h(*[cell(x) for x in (r[0], r[1], r[2], r[3], None if r[4] is None else r[4].replace("\n", ""))])
        by_source.setdefault(r[1], []).append((r[0], leaf, claim))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by_source[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[s] = climb([leaf for _, leaf, _ in by_source[s]], fanout)
    root, upper = climb([trees[s][0] for s in sources], fanout)
    out = []
    for s, above in zip(sources, upper):
        for (doc_id, leaf, claim), path in zip(by_source[s], trees[s][1]):
            folded = claim
            for left, right in path + above:
                folded = h(*left, folded, *right)
            proof = h(*[x for left, right in path + above for x in left + right])
            out.append((str(doc_id), str(s), leaf, trees[s][0], root, proof, folded, folded == root))
    return sorted(out)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for _ in range(n):
            text = rng.choice([None, "", "one\ntwo", "no break", "é\n中" * rng.randrange(3)])
            rows.append((rng.choice([None, rng.randrange(-50, 5000)]), source, rng.choice([None, "de"]), rng.choice([None, 3]), text, 1, 2, "x"))
    return rows


@pytest.mark.parametrize("block_levels", [0, 1, 7])
def test_manifest_is_the_brute_force_one(spark, block_levels):
    """Blocks of one leaf make every level a round of the exchange; sources of all sizes meet."""
    rows = rows_of({"b": 41, None: 5, "": 1, "ä": 28, "a": 3, "z": 9, "y": 1})
    rows += [rows[0]] * 4
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mm.manifest(df, F.replace("text", F.lit("\n"), F.lit("")), block_levels=block_levels)
    found = sorted((str(r.doc_id), str(r.source), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in got.collect())
    assert found == brute_force(rows)


def test_other_fanout_and_one_hot_source(spark):
    rows = rows_of({"hot": 70, "a": 1, "b": 2}, 5)
    got = mm.manifest(spark.createDataFrame(rows, SCHEMA), fanout=2, block_levels=2)
    want = brute_force([r[:4] + (r[4] and r[4].replace("\n", "N"),) + r[5:] for r in rows], 2)
    assert {r.root for r in got.collect()} != {w[4] for w in want}
    assert all(r.verified and r.folded_root == r.root for r in got.collect())


def test_lone_row_and_empty_table(spark):
    one = mm.manifest(spark.createDataFrame([(7, "s", None, 0, "", 0, 0, "")], SCHEMA)).collect()
    assert len(one) == 1 and one[0].leaf == one[0].subroot == one[0].root == h("1:7", "1:s", "-", "1:0", "0:")
    assert one[0].proof_sha256 == h() and one[0].verified
    assert mm.manifest(spark.createDataFrame([], SCHEMA)).count() == 0
