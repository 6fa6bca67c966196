"""Tables that grow by numbered commits, each of which counts once.

A commit is a folder of its own and stands when its job has ended. A writer that was cut
short, or does not know whether it was, writes the same number again: nothing is doubled, and
readers see committed rows only.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from threadwarden.sources.staging import COMPACT, list_folder, table_exists

_PREFIX = "commit="


def _folder(path: str, number: int) -> str:
    return f"{path.rstrip('/')}/{_PREFIX}{number}"


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits that stand, in order."""
    names = [n.removeprefix(_PREFIX) for n in list_folder(spark, path) if n.startswith(_PREFIX)]
    return sorted(int(n) for n in names if n.isdigit() and table_exists(spark, _folder(path, int(n))))


def next_commit(spark: SparkSession, path: str) -> int:
    return max(commits(spark, path), default=-1) + 1


def commit(df: DataFrame, path: str, number: int) -> bool:
    """Write ``df`` as commit ``number``; false, and nothing is evaluated, if that one stands already."""
    if table_exists(df.sparkSession, _folder(path, number)):
        return False
    df.write.mode("overwrite").option("compression", COMPACT).parquet(_folder(path, number))
    return True


def read_commits(spark: SparkSession, path: str, numbers: Iterable[int] | None = None) -> DataFrame:
    """The rows of all commits, or of some, under the columns of the first one."""
    standing = commits(spark, path)
    if not standing:
        raise ValueError(f"No commit stands in {path}")
    schema = spark.read.parquet(_folder(path, standing[0])).schema
    return spark.read.schema(schema).parquet(*[_folder(path, n) for n in (standing if numbers is None else numbers)])
