"""Silver tables: Parquet directories, replaced as a whole, or kept as versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from siltworks.sources.replace import replace_directory
from siltworks.sources.versions import current_location, has_versions, write_version


def silver_path(silver_dir: str, table: str) -> str:
    return f"{silver_dir.rstrip('/')}/{table}"


def silver_location(spark: SparkSession, silver_dir: str, table: str) -> str:
    """The directory with a silver table's Parquet files: of its current version, if it is kept as versions."""
    path = silver_path(silver_dir, table)
    return current_location(spark, path) if has_versions(spark, path) else path


def write_silver(df: DataFrame, path: str, *, keep_versions: int | None = None) -> int:
    """Replace the Parquet directory and return the number of rows written. A failed write leaves the old one.

    With ``keep_versions`` the table is kept as so many versions below ``path``: readers of ``read_silver`` and of
    catalog tables find one at any moment. The write counts its own rows in its last stage, where a retried task is not counted twice, so the
    plan runs once and the number is that of the rows on disk.
    """

    if keep_versions is not None:
        return write_version(df, path, keep=keep_versions)

    def write(staged: str) -> int:
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
        return seen.get["rows"]

    return replace_directory(df.sparkSession, path, write)


def read_silver(spark: SparkSession, silver_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(silver_location(spark, silver_dir, table))
