"""Helpers of the operators: intermediate tables and the sizes that decide how they are dealt out."""

from __future__ import annotations

import gc
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from siltworks.sources.replace import remove_directory
from siltworks.workspace import scratch_dir

# Space, tab, line feed, vertical tab, form feed, carriage return: what separates words.
BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back, which cuts the lineage for good."""
    path = scratch_dir(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove what ``written`` wrote, once all that is made from it has been written itself."""
    for table in tables:
        remove_directory(table.sparkSession, table._written_at)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans whose results are written, instead of when memory runs short.

    Spark drops a shuffle once nothing refers to its plan any more, which a driver with memory to spare finds out late.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def shuffle_width(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which its owner sizes to the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else. Plain ASCII takes the fast path; other text is mapped by character."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    return to_arrow_type(df.schema[column].dataType)


_SHIPPED: set[str] = set()


def arrow_map(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` on executors that need not have this package: its modules go to them once per session."""
    context = df.sparkSession.sparkContext
    package = Path(__file__).resolve().parents[1]
    if context.applicationId not in _SHIPPED and package.is_dir():
        home = tempfile.mkdtemp(prefix="siltworks-")  # of the driver alone: Spark serves the file from here
        with zipfile.ZipFile(f"{home}/siltworks_modules.zip", "w") as modules:
            for file in sorted(package.rglob("*.py")):
                modules.write(file, file.relative_to(package.parent))
        context.addPyFile(f"{home}/siltworks_modules.zip")
        _SHIPPED.add(context.applicationId)
    return df.mapInArrow(function, schema)
