"""Tables behind JDBC."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def camel_case(name: str) -> str:
    return re.sub(r"_+([a-zA-Z0-9])", lambda m: m.group(1).upper(), name.lower())


def camel_columns(df: DataFrame) -> DataFrame:
    """snake_case columns renamed to camelCase."""
    return df.withColumnsRenamed({c: camel_case(c) for c in df.columns})


def query_options(
    url: str, query: str, split_by: str | None = None, bounds: tuple[int, int] | None = None, splits: int = 1, **options: str
) -> dict[str, str]:
    """Reader options of a query; with `split_by` and its bounds it is read by several tasks."""
    out = {"url": url, "dbtable": f"({query}) q", "fetchsize": "10000", **options}
    if split_by and bounds:
        out |= {
            "partitionColumn": split_by,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(splits),
        }
    return out


def read_query(spark: SparkSession, url: str, query: str, camel: bool = False, **options) -> DataFrame:
    rows = spark.read.format("jdbc").options(**query_options(url, query, **options)).load()
    return camel_columns(rows) if camel else rows
