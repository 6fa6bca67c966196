"""Shards that each match the mixture of sources: proportional stratified interleaving.

The rows of a source are shuffled by a seeded hash and ranked. A row's fractional rank, its
rank over its source's size, spreads every source evenly over (0, 1). Sorted by fractional
rank, any run of rows holds the sources in their proportions, so equal cuts of that order are
shards that match the mixture, and so does every beginning of a shard. Ranks and positions are
distributed running totals over narrow rows; the texts are shuffled once, when the shards
are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadwarden.operators.distributed import running_total
from threadwarden.sources.staging import new_stage_path, stage

SHARDS = 16
# 128 bits that name a row by all its cells; rows that agree in them are the same row repeated.
_ROW = ("_row1", "_row2")


def _row_names(docs: DataFrame) -> list[Column]:
    # maps cannot be hashed, their JSON can
    cells = [F.to_json(F.struct(f"`{f.name}`")) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`") for f in docs.schema]
    # a hash skips null cells, so the nulls are hashed as well
    nulls = [F.col(f"`{f.name}`").isNull() for f in docs.schema]
    return [F.xxhash64(F.lit(seed), *cells, *nulls).alias(name) for seed, name in enumerate(_ROW)]


def shuffle_key(doc_id: Column, seed: int) -> Column:
    """The first 60 bits of the MD5 of seed and id: the seeded order of a source's rows."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def assign_shards(docs: DataFrame, shards: int = SHARDS, seed: int = 0, stratum: str = "source") -> DataFrame:
    """One narrow row (_row1, _row2, shard, slot) for every row of ``docs``.

    Shards hold equally many rows, give or take one; ``slot`` counts a shard's rows from 0 in
    order of their fractional rank. A null stratum is a stratum of its own. Rows of equal
    fractional rank, and rows repeated under one doc_id, are ordered by the seeded hash, then
    doc_id (null first), then a hash of all their cells; rows equal in every cell are
    interchangeable. The same rows and seed always give the same shards.
    """
    narrow = stage(
        docs.select(
            F.col(stratum).alias("_stratum"),
            F.col("doc_id").cast("bigint").alias("_doc"),
            shuffle_key(F.col("doc_id"), seed).alias("_key"),
            *_row_names(docs),
            F.lit(1).alias("_one"),
        ),
        "rows",
    )
    order = ["_key", "_doc", *_ROW]
    ranked = running_total(narrow, order, F.lit(1), "_rank", ["_stratum"], {"_n": (F.sum, "_one")})
    fraction = (F.col("_rank") + 0.5) / F.col("_n")
    ranked = stage(ranked.select(fraction.alias("_fraction"), *order, "_one"), "fractions")
    placed = running_total(ranked, ["_fraction", *order], F.lit(1), "_at", totals={"_all": (F.sum, "_one")})
    shard = F.expr(f"_at * {shards} div _all")
    return placed.withColumn("shard", shard.cast("int")).select(
        *_ROW, "shard", F.expr(f"_at - (shard * _all + {shards - 1}) div {shards}").alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, seed: int = 0, stratum: str = "source") -> DataFrame:
    """Write ``docs`` as Parquet below ``folder/shard=N`` and return what stands there.

    Columns: slot, row (a struct of all columns of ``docs``, so that none can clash), shard.
    Every file is a run sorted by slot. A shard has as many files as tasks wrote to it, so no
    shard passes through one task. An empty table gives no shard.
    """
    assigned = stage(assign_shards(docs, shards, seed, stratum), "assigned")
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("row"), *_row_names(docs))
    if not assigned.groupBy(*_ROW).count().filter("count > 1").isEmpty():
        # repeated rows are the same: one of them stands for every place that they have
        rows = rows.dropDuplicates(list(_ROW))
    placed = rows.join(assigned.hint("merge"), list(_ROW)).select("slot", "row", "shard")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return read_shards(docs.sparkSession, folder, docs.schema)


def read_shards(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """The shards in ``folder`` whose rows have ``schema``; order a shard by slot to read it."""
    whole = T.StructType().add("slot", T.LongType()).add("row", schema).add("shard", T.IntegerType())
    return spark.read.schema(whole).parquet(folder)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = 0) -> DataFrame:
    """``docs`` written to a new folder in shards by source, and read back."""
    return write_shards(docs, new_stage_path(docs.sparkSession, "shards"), shards, seed)
