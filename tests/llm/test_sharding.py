import random
from collections import Counter

from pyspark.sql import functions as F

from threadwarden.llm import sharding

SCHEMA = "doc_id bigint, text string, source string, shard string, slot bigint, _key int, kinds map<string,int>"


def table(spark, n=300, seed=2):
    rng = random.Random(seed)
    rows = [(rng.choice([None, i]), rng.choice([None, "", f"t{i}"]), rng.choice(["hot"] * 4 + ["a", None]), "s", i, None, {"k": i}) for i in range(n)]
    return spark.createDataFrame(rows + rows[:1] * 40, SCHEMA).repartition(4), rows + rows[:1] * 40


def test_shards_hold_every_row_once_in_the_mixture(spark, folder):
    df, rows = table(spark)
    got = sharding.write_shards(df, f"{folder}/out", shards=7, seed=3).collect()
    assert Counter(str(r.row.asDict()) for r in got) == Counter(str(r.asDict()) for r in df.collect())
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(7)) and max(sizes.values()) - min(sizes.values()) <= 1
    per_source = Counter(r[2] for r in rows)
    for shard in range(7):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(sizes[shard]))
        for source, n in per_source.items():
            share = sum(1 for r in got if r.shard == shard and r.row.source == source)
            assert abs(share - n / 7) <= 2


def test_every_beginning_of_a_shard_has_the_mixture(spark):
    df, rows = table(spark)
    got = sharding.shard_documents(df, shards=2).collect()
    hot = sum(r[2] == "hot" for r in rows) / len(rows)
    for shard in (0, 1):
        first = [r for r in got if r.shard == shard and r.slot < 60]
        assert abs(sum(r.row.source == "hot" for r in first) - 60 * hot) <= 3


def test_order_is_the_brute_force_one_and_repeats(spark):
    rows = [(i, f"t{i}", "abc"[i * i % 3]) for i in range(97)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    keys = {r.doc_id: r.k for r in df.select("doc_id", sharding.shuffle_key(F.col("doc_id"), 5).alias("k")).collect()}
    order = []
    for source in "abc":
        own = sorted((keys[r[0]], r[0]) for r in rows if r[2] == source)
        order += [((i + 0.5) / len(own), *k) for i, k in enumerate(own)]
    want = {doc: (at * 4 // 97, at - -(-(at * 4 // 97) * 97 // 4)) for at, (_, _, doc) in enumerate(sorted(order))}
    for parts in (1, 6):
        got = sharding.shard_documents(df.repartition(parts), shards=4, seed=5).collect()
        assert {r.row.doc_id: (r.shard, r.slot) for r in got} == want
    other = {r.row.doc_id: (r.shard, r.slot) for r in sharding.shard_documents(df, shards=4, seed=6).collect()}
    assert other != want


def test_files_are_runs_sorted_by_slot(spark, folder):
    df, _ = table(spark)
    sharding.write_shards(df, f"{folder}/out", shards=3)
    read = spark.read.parquet(f"{folder}/out").select(F.input_file_name().alias("f"), "shard", "slot").collect()
    by_file = {}
    for r in read:
        by_file.setdefault(r.f, []).append(r.slot)
    assert all(slots == sorted(slots) for slots in by_file.values())


def test_empty_table_and_fewer_rows_than_shards(spark):
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(i, "t", "s", "", 0, 0, {}) for i in range(3)]
    few = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len({r.shard for r in few}) == 3 and all(r.slot == 0 for r in few)
