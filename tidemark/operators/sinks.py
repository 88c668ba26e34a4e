"""Batch sinks: warehouse tables, exports, model artefacts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def jdbc_append(df: DataFrame, url: str, table: str, batchsize: int = 1000,
                properties: dict | None = None) -> None:
    """Append to a warehouse table (insert-if-absent is done before, with
    ``gold.insert_if_absent``); rows are sent in ``batchsize`` pages."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batchsize)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode("append").save()


def export(df: DataFrame, path: str, fmt: str = "parquet", single_file: bool = False) -> None:
    """Parquet (snappy) or CSV (header) export; ``single_file`` only for small
    results such as a head-n report."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.option("compression", "snappy").parquet(path)


def mapping_json_lines(mapping: DataFrame, path: str) -> None:
    """Category mapping as JSON lines ``{"feature":…, "value":…, "idx":…}``
    (scales with the vocabulary; no single in-memory dictionary)."""
    mapping.write.mode("overwrite").json(path)


def metrics_json(metrics: DataFrame, path: str) -> None:
    """Model metrics row(s) as JSON."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> dict[str, bool]:
    """Create (or replace) named views and report that each exists afterwards."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return {name: spark.catalog.tableExists(name) for name in tables}


# Analytical views over the warehouse's tables, by name.
VIEWS = {
    "vw_user_session_summary": """
SELECT e.user_id, e.user_session, count(*) AS event_count, min(e.event_timestamp) AS session_start,
       max(e.event_timestamp) AS session_end, count(DISTINCT e.product_id) AS unique_products_viewed
FROM {db}.fact_events e
LEFT SEMI JOIN {db}.dim_user u ON u.user_id = e.user_id
LEFT SEMI JOIN {db}.dim_date d ON d.event_date = e.event_date
LEFT SEMI JOIN {db}.dim_product p ON p.product_id = e.product_id
GROUP BY e.user_id, e.user_session""",
    "vw_category_performance": """
SELECT c.category_l1, c.category_l2, c.category_l3, count(*) AS view_count, count(DISTINCT e.user_id) AS unique_users,
       round(avg(cast(p.price AS DOUBLE)), 6) AS avg_price
FROM {db}.fact_events e
JOIN {db}.dim_category c ON c.category_id = e.category_id
JOIN {db}.dim_product p ON p.product_id = e.product_id
LEFT SEMI JOIN {db}.dim_user u ON u.user_id = e.user_id
GROUP BY c.category_l1, c.category_l2, c.category_l3""",
}


def publish_tables(spark: SparkSession, database: str, tables: dict[str, DataFrame], path: str) -> None:
    """Write ``tables`` as Parquet under ``path`` and name them in the catalog's
    ``database``.  They outlive the session.  A table of that name is replaced by
    one in a new folder, so readers under way keep the files that they read;
    other sessions see the new one after ``refreshTable``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        where = f"{path}/{name}-{uuid.uuid4().hex[:12]}"
        df.write.mode("overwrite").option("path", where).format("parquet").saveAsTable(f"{database}.{name}")


def publish_views(spark: SparkSession, database: str, views: dict[str, str] = VIEWS) -> dict[str, bool]:
    """Create or replace catalog views over the tables of ``database``; which of
    them existed before."""
    known = {name: spark.catalog.tableExists(f"{database}.{name}") for name in views}
    for name, text in views.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS {text.format(db=database)}")
    return known


def kafka_sink_stream(stream: DataFrame, topic: str, bootstrap: str, checkpoint: str, value: str = "value"):
    """Value-only string records to a Kafka topic (requires the connector jar).
    Publish validated records from ``validation.record_with_verdict``'s column."""
    return (stream.select(F.col(value).cast("string").alias("value")).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
