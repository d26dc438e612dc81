"""Database change records: unfolding row changes and routing by configuration."""

from __future__ import annotations

from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..constants import DWD_DEFAULT, RECORD_ID, SINK_DIM, SINK_STREAM
from ..schemas import ROUTING
from .joins import balanced_join

_ROUTE_KEYS = [("table", "source_table"), ("type", "operate_type")]


def explode_row_changes(entries: DataFrame) -> DataFrame:
    """One row per changed row image: deletes give the old image, inserts the new one, updates both in that order."""
    data = entries.where(~F.upper("entry_type").isin("TRANSACTIONBEGIN", "TRANSACTIONEND"))
    kind = F.lower("event_type")

    def image(name: str, row: Column, order: int) -> Column:
        return F.struct(F.lit(name).alias("image"), F.lit(order).alias("image_no"), row[name].alias("data"))

    def images(row: Column) -> Column:
        before, after = image("before", row, 0), image("after", row, 1)
        return (
            F.when(kind == "delete", F.array(before))
            .when(kind == "update", F.array(before, after))
            .when(kind == "insert", F.array(after))
        )

    kept = [c for c in entries.columns if c != "rows"]
    rows = data.select(*kept, F.posexplode("rows").alias("row_no", "_row"))
    return rows.select(*kept, "row_no", F.explode(images(F.col("_row"))).alias("_i")).select(*kept, "row_no", "_i.*")


def nonempty_data(cdc: DataFrame) -> DataFrame:
    return cdc.where("data is not null and size(data) > 0")


def normalise_type(cdc: DataFrame) -> DataFrame:
    """Rows of an initial load count as inserts."""
    return cdc.withColumn("type", F.when(F.col("type") == "bootstrap-insert", "insert").otherwise(F.col("type")))


def project_columns(data: Column, sink_columns: Column) -> Column:
    """The entries of `data` named in the comma-separated `sink_columns`."""
    names = F.split(sink_columns, ",")
    return F.map_filter(data, lambda key, _: F.array_contains(names, key))


def routing_rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Routing rows held on the driver as a table whose size Spark knows, so that it is broadcast."""
    columns = zip(*rows) if rows else [()] * len(ROUTING.names)
    table = pa.table({name: pa.array(values, pa.string()) for name, values in zip(ROUTING.names, columns)})
    return spark.createDataFrame(table)


def merged_routing(known: dict[tuple, tuple], fresh: list[tuple]) -> dict[tuple, tuple]:
    """Routing rows by table and operation after a reload: fresh rows are added or replace theirs, others stay."""
    at = [ROUTING.names.index(k) for _, k in _ROUTE_KEYS]
    return known | {tuple(row[i] for i in at): tuple(row) for row in fresh}


def route_changes(cdc: DataFrame, routing: DataFrame) -> DataFrame:
    """Give each change its `sink_type`, `sink_table` and `sink_pk` and keep the configured columns of `data`.

    Changes without a routing row, or with a target that has no writer, are left out.
    """
    routed = balanced_join(nonempty_data(normalise_type(cdc)), routing, _ROUTE_KEYS, spread_by=["xid"])
    kept = [F.col(f"b.{c}") for c in cdc.columns if c != "data"]
    return routed.where(F.col("s.sink_type").isin(SINK_STREAM, SINK_DIM)).select(
        *kept,
        project_columns(F.col("b.data"), F.col("s.sink_columns")).alias("data"),
        F.col("s.sink_type").alias("sink_type"),
        F.col("s.sink_table").alias("sink_table"),
        F.coalesce(F.col("s.sink_pk"), F.lit("id")).alias("sink_pk"),
    )


def unrouted_changes(cdc: DataFrame, routing: DataFrame) -> DataFrame:
    """Changes without a routing row."""
    return balanced_join(
        nonempty_data(normalise_type(cdc)), routing, _ROUTE_KEYS, "left_anti", spread_by=["xid"]
    )


def stream_changes(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == SINK_STREAM)


def dim_changes(routed: DataFrame) -> DataFrame:
    return routed.where(F.col("sink_type") == SINK_DIM)


def dim_routes(routing: DataFrame) -> DataFrame:
    """The routing rows that describe dimension tables."""
    return routing.where(F.col("sink_type") == SINK_DIM)


def topic_records(routed: DataFrame, default: str = DWD_DEFAULT) -> DataFrame:
    """Topic and JSON payload of each routed change, and its id where the source gives one (its place or an id of its own)."""
    topic = F.coalesce(F.col("sink_table"), F.lit(default))
    given = [F.col(c).cast("string") for c in ("log_id", RECORD_ID) if c in routed.columns]
    return routed.select(topic.alias("topic"), F.to_json("data").alias("value"), *([F.coalesce(*given).alias(RECORD_ID)] if given else []))


def where_equal(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Rows of a dimension whose columns equal the given values; at least one is needed."""
    if not values:
        raise ValueError("give at least one column to look up by")
    return df.where(reduce(and_, [F.col(c) == F.lit(v) for c, v in values.items()]))
