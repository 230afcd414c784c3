"""Header-less vertex and edge CSV files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphtide.plans.spec import quoted


# Blanks belong to the value, a bare field is null and a quoted empty one is empty text.
_PLAIN: Mapping[str, str] = {
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "nullValue": "", "emptyValue": '""', "escape": '"',
}


def read_label_csv(spark: SparkSession, path: str | list[str], schema: str, *, line_breaks: bool = False) -> DataFrame:
    """Read CSV with a given schema (DDL); a leading byte order mark is ignored.

    A line that does not fit the schema fails the read instead of turning into
    nulls.  ``line_breaks`` reads values that hold line breaks, at the price that
    a file is no longer split.
    """
    options = {**_PLAIN, "emptyValue": "", "multiLine": str(line_breaks).lower()}
    return spark.read.schema(schema).option("mode", "FAILFAST").options(**options).csv(path)


def write_label_csv(df: DataFrame, path: str, *, line_breaks: bool = False) -> None:
    """Write CSV that ``read_label_csv`` reads back as it was.

    A value with a line break fails the write unless ``line_breaks`` allows it.
    """
    if not line_breaks:
        broken = F.lit("a value holds a line break: allow it with line_breaks=True")
        for name, kind in df.dtypes:
            if kind == "string":
                text = F.col(quoted(name))
                df = df.withColumn(name, F.when(text.rlike(r"[\r\n]"), F.raise_error(broken).cast("string")).otherwise(text))
    df.write.mode("overwrite").options(**_PLAIN).csv(path)
