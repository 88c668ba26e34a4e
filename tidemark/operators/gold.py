"""Gold layer: star schema (dimensions + fact), integrity checks, analytical views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.joins import measured_broadcast
from tidemark.operators.silver import first_per_key

FACT_COLUMNS = ["event_id", "event_type", "user_id", "product_id", "category_id", "event_date",
                "event_timestamp", "user_session", "events_in_session"]


def dim_user(silver: DataFrame) -> DataFrame:
    return silver.select(F.col("user_id").cast("bigint").alias("user_id")).distinct()


def dim_product(silver: DataFrame) -> DataFrame:
    """PK product_id; the first row per product wins (insert-if-absent semantics)."""
    d = first_per_key(silver.select("product_id", "brand", "price", "price_tier", "ingest_seq"),
                      ["product_id"])
    return d.select(F.col("product_id").cast("bigint"), "brand",
                    F.col("price").cast("decimal(10,2)").alias("price"), "price_tier")


def dim_category(silver: DataFrame) -> DataFrame:
    d = first_per_key(silver.select("category_id", "category_code", "category_l1", "category_l2",
                                    "category_l3", "ingest_seq"), ["category_id"])
    return d.drop("ingest_seq")


def dim_date(silver: DataFrame, hourly: bool = False) -> DataFrame:
    """PK event_date only (one hour per date survives); ``hourly`` keeps (date, hour)."""
    keys = ["event_date", "event_hour"] if hourly else ["event_date"]
    d = first_per_key(silver.select("event_date", "event_hour", "day_of_week", "ingest_seq"), keys)
    return d.drop("ingest_seq")


def fact_events(silver: DataFrame) -> DataFrame:
    """Fact rows under the source's arrival sequence as identifier; ``keys.load_with_keys``
    gives them generated keys that go on from load to load."""
    return silver.select(
        F.col("ingest_seq").alias("event_id"), "event_type",
        F.col("user_id").cast("bigint"), F.col("product_id").cast("bigint"),
        F.col("category_id").cast("bigint"), "event_date", "event_timestamp", "user_session",
        F.col("events_in_session").cast("bigint"))


def fk_orphans(fact: DataFrame, dims: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Count fact rows whose key is absent from each dimension (anti-joins)."""
    out = None
    for name, (dim, key) in dims.items():
        # dimensions are unique on their key (materialised gold tables)
        o = (fact.select(key).join(_dim(dim, [key]), key, "left_anti")
             .agg(F.count(F.lit(1)).alias("orphans"))
             .select(F.lit(name).alias("dimension"), "orphans"))
        out = o if out is None else out.unionByName(o)
    return out


def insert_if_absent(new: DataFrame, existing: DataFrame, pk: list[str], order: str = "ingest_seq") -> DataFrame:
    """Rows of ``new`` whose key is not yet in ``existing`` (ON CONFLICT DO NOTHING),
    the first row per key within ``new`` (by ``order``: for instance topic,
    partition and offset, or file and position) winning.

    Copies are collapsed first (a partial aggregate, so a key repeated across
    a third of the rows shrinks map-side) and only then anti-joined.
    """
    if order not in new.columns:
        raise ValueError(f"insert_if_absent needs the arrival order column {order!r}: without it 'first' is not defined")
    fresh = first_per_key(new, pk, order)
    return fresh.join(existing.select(*pk).distinct(), pk, "left_anti")


def _dim(df: DataFrame, cols: list[str]) -> DataFrame:
    """Projected dimension for a star join: broadcast when its measured size is
    bounded (dimensions are materialised tables), otherwise a shuffle join."""
    return measured_broadcast(df.select(*cols))


def vw_user_session_summary(fact: DataFrame, d_user: DataFrame, d_date: DataFrame,
                            d_product: DataFrame) -> DataFrame:
    """Session summary; the three dimension joins only test key existence
    (each dimension is unique on its key), so they are semi-joins."""
    f = (fact.join(_dim(d_user, ["user_id"]), "user_id", "left_semi")
         .join(_dim(d_date, ["event_date"]), "event_date", "left_semi")
         .join(_dim(d_product, ["product_id"]), "product_id", "left_semi"))
    return (f.groupBy("user_id", "user_session")
            .agg(F.count(F.lit(1)).alias("event_count"),
                 F.min("event_timestamp").alias("session_start"),
                 F.max("event_timestamp").alias("session_end"),
                 F.count_distinct("product_id").alias("unique_products_viewed")))


def vw_category_performance(fact: DataFrame, d_category: DataFrame, d_user: DataFrame,
                            d_product: DataFrame) -> DataFrame:
    f = (fact.select("category_id", "user_id", "product_id")
         .join(_dim(d_category, ["category_id", "category_l1", "category_l2", "category_l3"]), "category_id")
         .join(_dim(d_user, ["user_id"]), "user_id", "left_semi")
         .join(_dim(d_product, ["product_id", "price"]), "product_id"))
    return (f.groupBy("category_l1", "category_l2", "category_l3")
            .agg(F.count(F.lit(1)).alias("view_count"),
                 F.count_distinct("user_id").alias("unique_users"),
                 F.round(F.avg(F.col("price").cast("double")), 6).alias("avg_price")))
