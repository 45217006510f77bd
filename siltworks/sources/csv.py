"""CSV in and out. A path may be one file, a directory of part files or a glob.

Files are read one record per line, so plain (uncompressed) files split across tasks whatever their
size; ``multi_line`` reads line breaks inside quotes, with one task per file. Bad values become NULL and the row
stays; short rows are padded with NULL and long rows cut. With ``flag_malformed`` rows are parsed
whole, whatever columns are asked for, and the column ``MALFORMED`` has the text of such rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltworks.contracts import TableContract

# RFC 4180 doubles a quote inside a quoted field; Spark's own default is a backslash before it.
_DOUBLED_QUOTE = {"escape": '"'}
MALFORMED = "_corrupt_record"  # Spark's own name
_TIMESTAMP_OUT = "yyyy-MM-dd HH:mm:ss.SSSSSSXXX"
_TIMESTAMP_NTZ_OUT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


# Fields in quotes, for counting the separators outside them: quotes inside are doubled, or follow a backslash.
_DOUBLED, _ESCAPED = r'"[^"]*+(?:""[^"]*+)*+"', r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def field_count(line: Column, rfc4180: bool = True) -> Column:
    """How many fields a line has, for telling short rows from long ones among those that the reader has marked."""
    return F.size(F.split(F.regexp_replace(line, _DOUBLED if rfc4180 else _ESCAPED, ""), ",", -1))


def _reader(spark: SparkSession, rfc4180: bool, multi_line: bool = False) -> DataFrameReader:
    reader = spark.read.option("header", True).option("multiLine", multi_line)
    return reader.options(**_DOUBLED_QUOTE) if rfc4180 else reader


def _flagged(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(MALFORMED, T.StringType())])


def scan_contract(
    spark: SparkSession, contract: TableContract, path: str, *, rfc4180: bool = True, check_header: bool = False,
    multi_line: bool = False, flag_malformed: bool = False,
) -> DataFrame:
    """Read with the contract's schema. Columns bind by position: header names are not looked at.

    ``check_header`` fails the read when the header's names differ from the contract's.
    ``rfc4180=False`` reads quotes as Spark does by default (backslash escapes).
    """
    return (
        _reader(spark, rfc4180, multi_line)
        .option("enforceSchema", not check_header)
        .option("columnPruning", not flag_malformed)
        .schema(_flagged(contract.schema) if flag_malformed else contract.schema)
        .csv(path)
    )


def scan_strings(
    spark: SparkSession, path: str, *, rfc4180: bool = True, multi_line: bool = False, flag_malformed: bool = False
) -> DataFrame:
    """Read every column as string, named by the header. Rows with more or fewer fields than it are malformed."""
    rows = _reader(spark, rfc4180, multi_line).csv(path)
    if not flag_malformed or not rows.columns:
        return rows
    return _reader(spark, rfc4180, multi_line).option("columnPruning", False).schema(_flagged(rows.schema)).csv(path)


def scan_inferred(spark: SparkSession, path: str, *, rfc4180: bool = True) -> DataFrame:
    """Read with types inferred from all values, which costs one more pass over the files."""
    return _reader(spark, rfc4180).option("inferSchema", True).csv(path)


def write_strings(df: DataFrame, path: str, *, partition_by: str | None = None) -> None:
    """Replace a CSV directory so that the scans above read the same values back.

    ``partition_by`` puts the rows into one directory per value of that column. Every part file has the header, padding is kept and timestamps keep their microseconds. CSV has no form
    for an empty string, which reads back as NULL, and values must not hold line breaks; no scan gives either.
    """
    writer = df.write.mode("overwrite")
    (
        (writer.partitionBy(partition_by) if partition_by else writer)
        .option("header", True)
        .options(**_DOUBLED_QUOTE)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("timestampFormat", _TIMESTAMP_OUT)
        .option("timestampNTZFormat", _TIMESTAMP_NTZ_OUT)
        .csv(path)
    )
