"""CSV and Parquet readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The texts that stand for a missing value in a catalogue file.
MISSING_TOKENS = ("", "NA", "null")


# Stands for a missing value while a file is read; empty text is quoted in the files, missing is not.
UNQUOTED = "\u0001missing"


def read_catalog_csv(
    spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """Quoted UTF-8 CSV with a header; blanks trimmed, missing tokens to NULL.

    Columns are found by their names in the header, in any order; further ones
    are ignored, a missing one raises, and so does a file whose header differs
    from that of the first. Fields are read as text and cast afterwards, because
    one CSV option can name only one missing token. Large files are split
    among tasks; ``multi_line`` is for values with line breaks and gives each
    file to one task.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("enforceSchema", False)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
    )
    header = [c.strip() for c in reader.csv(path).columns]
    absent = [f.name for f in schema if f.name not in header]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in the header of {path}")
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = reader.schema(as_text).csv(path)
    return raw.select(
        *[
            F.when(~F.trim(F.col(f.name)).isin(*MISSING_TOKENS), F.trim(F.col(f.name)))
            .try_cast(f.dataType)
            .alias(f.name)
            for f in schema
        ]
    )


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table; only ``columns`` are scanned when they are given."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_result_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A result table written by ``write_csv``, with typed columns and line breaks restored."""
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", UNQUOTED)
        .option("emptyValue", "")
        .csv(path)
    )
    return raw.select(*[_unescaped(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name) for f in schema])


def _escaped(c: str) -> Column:
    out = F.replace(F.col(c), F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(out, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")).alias(c)


def _unescaped(c: str) -> Column:
    """Pairs of backslashes are set aside as a NUL character while breaks are restored."""
    out = F.replace(F.col(c), F.lit("\\\\"), F.lit("\u0000"))
    out = F.replace(F.replace(out, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    return F.replace(out, F.lit("\u0000"), F.lit("\\")).alias(c)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """The distinct non-empty values of one column."""
    return df.select(column).filter(F.trim(F.col(column).cast("string")) != "").distinct()


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrites a stage table, one folder per value of ``partition_by``.

    The rows are rebalanced on those columns first: a small month becomes one
    file instead of one per task, and a hot month is split among tasks.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    balanced = df.hint("rebalance", *partition_by)
    balanced.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Overwrites a result table as CSV with a header.

    Missing values are left empty and empty text is quoted. Backslashes and line
    breaks in texts are escaped with a backslash, so a row is one line and
    large files stay splittable.
    """
    texts = [c for c, kind in df.dtypes if kind == "string"]
    (
        df.withColumns({c: _escaped(c) for c in texts})
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("nullValue", "")
        .option("emptyValue", '""')
        .csv(path)
    )
