import glob
import os

import pytest
from pyspark.sql import functions as F

from threadwarden import schemas
from threadwarden.sources import ledger, staging, tables


def test_csv_round_trip_keeps_text(spark, folder):
    cells = ['say "hi"', "two\nlines", "ends with \\", "  blanks  ", "a,b", "\ttab", "cr\r\nlf", 'quote at end"', "é \U0001f600"]
    rows = [(str(i), c, float(i)) for i, c in enumerate(cells)] + [("90", None, None), ("91", "", 1.0), ("92", "NA", 2.0), ("93", "None", 3.0)]
    df = spark.createDataFrame(rows, "Id string, BODY string, n double")
    tables.write_csv(df, f"{folder}/csv")
    got = {r.id: (r.body, r.n) for r in tables.read_csv(spark, f"{folder}/csv", "id string, body string, n double, absent int").collect()}
    assert got == {i: (None if c in ("", "NA", "None") else c, n) for i, c, n in rows}


def test_hand_written_csv(spark, folder):
    with open(f"{folder}/posts.csv", "w", encoding="utf-8") as f:
        f.write('ID,Title,Score,Over_18\n007,"a ""quoted"" title",n/a,True\n8,"line 1\nline 2",2.5,\n')
    rows = tables.read_csv(spark, f"{folder}/posts.csv", "id string, title string, score double, over_18 boolean").collect()
    assert [tuple(r) for r in rows] == [("007", 'a "quoted" title', None, True), ("8", "line 1\nline 2", 2.5, None)]


def test_long_cells_are_read_whole(spark, folder):
    df = spark.createDataFrame([("1", "x" * 300_000)], "id string, body string")
    tables.write_csv(df, f"{folder}/long")
    assert tables.read_csv(spark, f"{folder}/long", "id string, body string").select(F.length("body")).first()[0] == 300_000


def test_aligned_append(spark, folder):
    path = f"{folder}/t"
    tables.append_aligned(spark.createDataFrame([("1", 2.0)], "ID string, Score double"), path)
    tables.append_aligned(spark.createDataFrame([(3, "2", "x")], "score int, id string, extra string"), path)
    tables.append_aligned(spark.createDataFrame([("3",)], "id string"), path)
    table = tables.read_appended(spark, path)
    assert table.dtypes == [("id", "string"), ("score", "double")]
    assert sorted(tuple(r) for r in table.collect() if r.score) == [("1", 2.0), ("2", 3.0)]
    first = f"{folder}/fresh"
    tables.append_aligned(spark.createDataFrame([("u",)], "username string"), first, schemas.scores_schema(["threat"]))
    assert tables.read_appended(spark, first).columns == schemas.scores_schema(["threat"]).names


def test_an_append_given_twice_counts_once(spark, folder):
    path = f"{folder}/t"
    rows = spark.createDataFrame([("1",)], "id string")
    assert tables.append_aligned(rows, path, number=7) and not tables.append_aligned(rows, path, number=7)
    assert tables.append_aligned(rows, path) and tables.read_appended(spark, path).count() == 2
    assert ledger.commits(spark, path) == [7, 8]


def test_an_append_cut_short_is_not_read_and_written_again(spark, folder):
    path = f"{folder}/t"
    ledger.commit(spark.range(3), path, 0)

    def broken(batches):
        yield from batches
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        ledger.commit(spark.range(5).mapInArrow(broken, "id bigint"), path, 1)
    assert ledger.commits(spark, path) == [0] and ledger.read_commits(spark, path).count() == 3
    assert ledger.next_commit(spark, path) == 1 and ledger.commit(spark.range(5), path, 1)
    assert ledger.read_commits(spark, path).count() == 8 and ledger.read_commits(spark, path, [1]).count() == 5
    with pytest.raises(ValueError, match="No commit"):
        ledger.read_commits(spark, f"{folder}/nothing")


def test_materialize_once(spark, folder):
    path = f"{folder}/once"
    assert tables.materialize(spark, path, lambda: spark.range(3)).count() == 3
    assert tables.materialize(spark, path, lambda: spark.range(5)).count() == 3
    assert tables.materialize(spark, path, lambda: spark.range(5), refresh=True).count() == 5


def test_first_existing_wants_a_finished_table(spark, folder):
    spark.range(2).write.parquet(f"{folder}/plain")
    spark.range(9).write.parquet(f"{folder}/ranked/_temporary/0")
    assert tables.first_existing(spark, f"{folder}/ranked", f"{folder}/plain").count() == 2
    with pytest.raises(ValueError):
        tables.first_existing(spark, f"{folder}/nowhere")


def test_config_and_assets(spark, folder):
    with open(f"{folder}/targets.json", "w") as f:
        f.write('{\n "subreddits": ["a", "b"],\n "search_terms": ["x y", "z"],\n "requestedAttributes": {"TOXICITY": {"scoreType": "PROBABILITY"}}\n}')
    with open(f"{folder}/prompt.md", "w") as f:
        f.write("line 1\n\nline 3\n")
    config = tables.read_config(spark, f"{folder}/targets.json")
    assert [r.subreddit for r in tables.config_subreddits(config).collect()] == ["a", "b"]
    assert [tuple(r) for r in tables.config_terms(config).collect()] == [(0, "x y"), (1, "z")]
    assert [tuple(r) for r in tables.config_attributes(config).collect()] == [(0, "toxicity")]
    assert tables.read_asset(spark, f"{folder}/prompt.md") == "line 1\n\nline 3\n"


def test_entities_lie_in_community_folders(spark, folder):
    df = spark.createDataFrame([("s1", "a"), ("s2", "b")], "subreddit string, id string")
    tables.write_entities(df, f"{folder}/json")
    assert len(glob.glob(f"{folder}/json/subreddit=*")) == 2
    assert tables.read_entities(spark, f"{folder}/json", df.schema).count() == 2


def test_stage_tables(spark):
    staged = staging.stage(spark.range(4).withColumn("p", F.spark_partition_id()), "x")
    assert staged.columns == ["id", "p"] and staged.count() == 4
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        assert staging.stage_root(spark).startswith(base)
    path, seen = staging.write_stage(spark.range(10), "y", most=F.max("id"))
    assert seen["most"] == 9
    assert staging.read_stages(spark.range(1), path, path).count() == 20


def test_whole_numbers_written_with_a_point(spark, folder):
    spark.createDataFrame([("12.0", "a", "1"), ("9007199254740993.0", "e", ""), ("7", "b", "x"), ("1.5", "c", ""), ("bad", "d", "9")], "n string, id string, m string").write.option("header", "true").csv(f"{folder}/n")
    got = tables.read_csv(spark, f"{folder}/n", "id string, n bigint, m int", malformed="odd")
    assert sorted((r.id, r.n, r.m, r.odd) for r in got.collect()) == [("a", 12, 1, []), ("b", 7, None, ["m"]), ("c", None, None, ["n"]), ("d", None, 9, ["n"]), ("e", 9007199254740993, None, [])]


def test_entities_lie_in_files_by_counted_rows(spark, folder):
    """A community of most rows is written by many tasks, small ones and the null one by one."""
    rows = spark.range(400).selectExpr("cast(id as string) as id", "case when id % 20 = 0 then null when id % 7 = 0 then 'small' else 'hot' end as subreddit")
    # so few bytes would be put together again
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_entities(rows.repartition(16), f"{folder}/e", rows_per_file=60)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tables.read_entities(spark, f"{folder}/e", rows.schema).count() == 400
    files = lambda name: sum(f.endswith(".json") for f in os.listdir(f"{folder}/e/subreddit={name}"))
    assert files("__HIVE_DEFAULT_PARTITION__") == files("small") == 1 and 2 <= files("hot") <= 6
