"""Scans and sinks: CSV with null rules, config and asset files, aligned appends."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadwarden import schemas
from threadwarden.functions.clean import NULL_TOKENS, lower_header, nulls_from_tokens
from threadwarden.sources import ledger
from threadwarden.sources.staging import table_exists

# Quoted cells may hold line breaks, doubled quotes, backslashes and outer blanks.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "multiLine": "true",
    "lineSep": "\n",
    "maxCharsPerColumn": "-1",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    null_tokens: Sequence[str] = NULL_TOKENS,
    malformed: str | None = None,
) -> DataFrame:
    """CSV table with lower-cased header; empty and null-like cells become null.

    Cells are read as text and cast, so that a null-like cell of a number column is null
    rather than an error. Ids stay text. Since cells may hold line breaks, each file is
    read by one task: deliver large tables as many files.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = lower_header(spark.read.options(**CSV_OPTIONS).option("inferSchema", "false").csv(path))
    return conform(nulls_from_tokens(raw, null_tokens), wanted, malformed)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV without row labels; text cells come back unchanged, empty ones as null.

    Arrays are written as JSON text. CSV is for the edges: stage tables are Parquet.
    """
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(f.name)
        for f in df.schema
    ]
    options = {k: v for k, v in CSV_OPTIONS.items() if k not in ("multiLine", "maxCharsPerColumn")}
    df.select(*flat).write.mode(mode).options(**options).option("quoteAll", "true").csv(path)


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _from_text(cell: Column, kind: T.DataType) -> Column:
    """A text cell as ``kind``, null if it is none; a whole number may be written as 12.0."""
    plain = cell.try_cast(kind)
    if isinstance(kind, WHOLE):
        # a decimal keeps every digit of a whole number, a double does not
        number = cell.try_cast("decimal(38,18)")
        return F.coalesce(plain, F.when(number == F.floor(number), F.floor(number).try_cast(kind)))
    return plain


def conform(df: DataFrame, schema: T.StructType, malformed: str | None = None) -> DataFrame:
    """The columns of ``schema``, in order: cast where present, null where absent.

    A text cell that is not of its column's type becomes null; with ``malformed`` a column of
    that name lists the columns in which a row has such cells.
    """
    present = {c.lower(): c for c in df.columns}
    types = dict(df.dtypes)

    def column(field: T.StructField):
        if field.name.lower() not in present:
            return F.lit(None).cast(field.dataType)
        source = present[field.name.lower()]
        if types[source] == "string" and isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.from_json(source, field.dataType)
        if types[source] == "string":
            return _from_text(F.col(source), field.dataType)
        return F.col(source).cast(field.dataType)

    columns = [column(f).alias(f.name) for f in schema]
    if malformed is not None:
        texts = [f for f in schema if types.get(present.get(f.name.lower())) == "string"]
        bad = [F.when(F.col(present[f.name.lower()]).isNotNull() & column(f).isNull(), F.lit(f.name)) for f in texts]
        columns.append(F.array_compact(F.array(*bad)).cast("array<string>").alias(malformed))
    return df.select(*columns)


def append_aligned(df: DataFrame, path: str, schema: T.StructType | None = None, number: int | None = None) -> bool:
    """Append rows to a Parquet table under the table's own columns; read it with ``read_appended``.

    The columns are those of the existing table, else of ``schema``, else the lower-cased
    ones of ``df``. Columns the rows lack become null; columns the table lacks are left out.
    ``number`` names the append: one that stands already is not repeated, and false is returned.
    Without it the append takes the next number.
    """
    spark = df.sparkSession
    rows = lower_header(df)
    standing = ledger.commits(spark, path)
    if standing:
        rows = conform(rows, ledger.read_commits(spark, path).schema)
    elif schema is not None:
        rows = conform(rows, T.StructType([T.StructField(f.name.lower(), f.dataType) for f in schema]))
    return ledger.commit(rows, path, max(standing, default=-1) + 1 if number is None else number)


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all appends that stand."""
    return ledger.read_commits(spark, path)


def write_entities(df: DataFrame, path: str, by: str = "subreddit", mode: str = "errorifexists", rows_per_file: int = 100_000) -> None:
    """One JSON record per entity, in one folder per community.

    A community is dealt over as many tasks as ``rows_per_file`` goes into its counted rows;
    adaptive execution puts shares of few bytes together again. ``df`` is evaluated twice: pass a stored table.
    """
    counts = df.groupBy(F.col(by).alias("_by")).agg(F.ceil(F.count(F.lit(1)) / rows_per_file).alias("_files"))
    share = F.pmod(F.xxhash64(*[f.name for f in df.schema if not isinstance(f.dataType, T.MapType)]), F.col("_files"))
    dealt = df.join(counts, F.col(by).eqNullSafe(F.col("_by"))).withColumn("_share", share)
    dealt.repartition(F.col(by), F.col("_share")).select(*df.columns).write.mode(mode).partitionBy(by).json(path)


def read_entities(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def materialize(spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """The table at ``path``; built and saved first if it is absent or ``refresh`` is set."""
    if refresh or not table_exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def first_existing(spark: SparkSession, *paths: str) -> DataFrame:
    """The first table that exists, e.g. the ranked conversations, else the unranked ones."""
    for path in paths:
        if table_exists(spark, path):
            return spark.read.parquet(path)
    raise ValueError(f"None of these tables exists: {list(paths)}")


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """The targeting file as one row of arrays and a map."""
    return spark.read.schema(schemas.CONFIG).option("multiLine", "true").json(path)


def config_subreddits(config: DataFrame) -> DataFrame:
    return config.select(F.explode("subreddits").alias("subreddit"))


def config_terms(config: DataFrame) -> DataFrame:
    """Search terms with their position in the file."""
    return config.select(F.posexplode("search_terms").alias("term_no", "term"))


def config_attributes(config: DataFrame) -> DataFrame:
    return config.select(F.posexplode(F.map_keys("requestedAttributes")).alias("attribute_no", "attribute")).withColumn(
        "attribute", F.lower("attribute")
    )


def read_asset(spark: SparkSession, path: str) -> str:
    """A prompt or response schema file as one text."""
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise ValueError(f"Asset file does not exist or is empty: {path}")
    return rows[0][0]
