"""A training corpus from raw documents, in five stages.

language ID -> near duplicates -> benchmark decontamination -> mixing -> token
files.  Each stage takes (spark, docs, sf_dir), works on all rows that the one
before it kept, and returns the columns of ``docs`` (the last: the digest of the
token files).  A stage's result is written as Parquet and reread as the next
one's docs; a stage may then drop the scratch tables of the one before.

A stage that decides about rows numbers them by their place, file and row, in the
table that it reads.  So identifiers may repeat or be null, and rows that are equal in
all columns are still told apart.
"""

from __future__ import annotations

import threading

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop_scratch, own_scratch, scratch_table, written
from tidemark.llm.decontaminate import find_contamination
from tidemark.llm.jaccard_join import jaccard_components
from tidemark.llm.langid import UNKNOWN, identify_languages, train_on
from tidemark.llm.mixing import poisson_mix
from tidemark.llm.token_files import token_digest

# A text is rejected when no language is found, or none with this probability.
MIN_LANGUAGE_SCORE = 0.35
# Files of a table up to which their numbers are broadcast.
MAX_FILES = 100_000

ORACLE_SQL = None  # a trained network and a tokenizer: tested by brute force

# Scratch tables of the last stage that this thread ran: runs side by side must
# not drop each other's.
_LAST = threading.local()


def _stage(fn):
    """The stage, with the scratch tables of the stage before dropped first:
    what that one returned has been written by now."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_scratch(spark, getattr(_LAST, "tables", []))
        _LAST.tables = []
        with own_scratch() as tables:
            out = fn(spark, docs, sf_dir)
        _LAST.tables = tables
        return out

    run_stage.__name__, run_stage.__doc__ = fn.__name__, fn.__doc__
    return run_stage


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number of their own under a name that no column has, the
    same whenever they are read: a scan's rows by file and place, any other rows
    written with a number first."""
    name, path, place = (_free(n, docs.columns) for n in ("row_number", "row_path", "row_place"))
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    except AnalysisException:  # no scan of files
        placed = None
    if placed is not None:
        files = written(placed.select(path).distinct().withColumn(
            name, F.row_number().over(Window.orderBy(path)).cast("long")), "files")  # one row a file
        if files.count() <= MAX_FILES:
            number = F.shiftleft(F.col(name), 40) + F.col(place)
            return placed.join(F.broadcast(files), path).withColumn(name, number).select(*docs.columns, name), name
    return written(docs.withColumn(name, F.monotonically_increasing_id()), "numbered"), name


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _without(numbered: DataFrame, name: str, rejected: DataFrame) -> DataFrame:
    """The rows whose number is not in ``rejected`` (one column of numbers)."""
    gone = written(rejected.toDF("gone"), "rejected")
    return numbered.join(gone, F.col(name) == F.col("gone"), "left_anti").drop(name)


@_stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts of a recognised language; null, letterless and unclear ones go."""
    numbered, row = _numbered(docs)
    found = identify_languages(numbered.select(row, "text"), id_col=row, net=train_on(docs))
    return _without(numbered, row, found.filter((F.col("lang_pred") == UNKNOWN) | (F.col("score") < MIN_LANGUAGE_SCORE)).select("doc_id"))


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near duplicates: that of the smallest
    identifier, and of these the first."""
    numbered, row = _numbered(docs)
    component = written(jaccard_components(numbered.select(row, "text"), id_col=row)
                        .select(F.col("doc_id").alias("row"), F.col("component_id").alias("component")), "near-components")
    groups = component.groupBy("component").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("component")
    members = component.join(groups, "component").join(numbered.select(F.col(row).alias("row"), "doc_id"), "row")
    stays = members.groupBy("component").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("last"), "doc_id", "row")).getField("row").alias("stay"))
    return _without(numbered, row, members.join(stays, "component").filter("row != stay").select("row"))


@_stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage."""
    numbered, row = _numbered(docs)
    found = find_contamination(numbered.select(row, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=row)
    return _without(numbered, row, found.filter("contaminated").select("doc_id"))


@_stage
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the square-root mixture of their sources, shuffled."""
    mixed = poisson_mix(docs)
    return mixed.select(*[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])


@_stage
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The digest of the token files that the corpus was written to."""
    return token_digest(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_files", token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_table(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
