"""Bronze -> silver -> gold as one lazy DataFrame chain over the given tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import bronze as B
from tidemark.operators import gold as G
from tidemark.operators import silver as S
from tidemark.session import materialize
from tidemark.sources.testdata import behaviour_events


def bronze_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.with_record_hash(behaviour_events(spark, sf_dir))


def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated rows with times and derived columns, before the session join."""
    return S.add_derived(S.silver_time(S.dedup_first(B.bronze_valid(bronze_input(spark, sf_dir)))))


def silver_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.with_session_metrics(clean_rows(spark, sf_dir))


class Gold:
    """Dimensions and fact of one warehouse run.

    The deduplicated rows are a materialised layer and each dimension a
    materialised gold table, created on first use only; a dimension's measured
    size then decides broadcast vs. shuffle in the star joins.  Dimensions,
    labels and counts read the layer as it is; only the fact joins the session
    metrics on.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._sf = spark, sf_dir

    @cached_property
    def clean(self) -> DataFrame:
        return materialize(clean_rows(self._spark, self._sf))

    @cached_property
    def dim_user(self) -> DataFrame:
        return materialize(G.dim_user(self.clean))

    @cached_property
    def dim_product(self) -> DataFrame:
        return materialize(G.dim_product(self.clean))

    @cached_property
    def dim_category(self) -> DataFrame:
        return materialize(G.dim_category(self.clean))

    @cached_property
    def dim_date(self) -> DataFrame:
        return materialize(G.dim_date(self.clean))

    @cached_property
    def fact(self) -> DataFrame:
        return G.fact_events(S.with_session_metrics(self.clean))

    @cached_property
    def events(self) -> DataFrame:
        """The fact's rows without its session column."""
        return G.fact_events(self.clean.withColumn("events_in_session", F.lit(None).cast("bigint"))).drop("events_in_session")

    def vw_user_session_summary(self) -> DataFrame:
        return G.vw_user_session_summary(self.events, self.dim_user, self.dim_date, self.dim_product)

    def vw_category_performance(self) -> DataFrame:
        return G.vw_category_performance(self.events, self.dim_category, self.dim_user, self.dim_product)
