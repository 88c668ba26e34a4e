"""Data-lake JSON scans: explicit schema, corrupt-record capture, file lineage,
incremental new-file detection and per-file ingest counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def _scan_schema(schema: T.StructType) -> T.StructType:
    return schema if CORRUPT in schema.fieldNames() else T.StructType(
        schema.fields + [T.StructField(CORRUPT, T.StringType())])


def lake_json_scan(spark: SparkSession, path: str | list[str], schema: T.StructType,
                   multiline: bool = False) -> DataFrame:
    """Scan JSON files with an explicit schema (no inference pass).

    ``multiline`` reads each file as one JSON value (an object, or an array
    whose elements become rows); otherwise JSON lines.  Unparsable input is
    kept in ``_corrupt_record``; every row carries its source file path/size.
    """
    r = (spark.read.schema(_scan_schema(schema)).option("mode", "PERMISSIVE")
         .option("columnNameOfCorruptRecord", CORRUPT).option("multiLine", multiline))
    df = r.json(path)
    return df.select("*", _canonical(F.col("_metadata.file_path")).alias("file_path"),
                     F.col("_metadata.file_size").alias("file_size"))


def _canonical(path: Column) -> Column:
    """One spelling of a file's address (``file:/x`` and ``file:///x``)."""
    return F.regexp_replace(path, r"^([a-zA-Z][\w+.-]*):/+(?=[^/])", "$1:/")


def lake_files(spark: SparkSession, path: str) -> DataFrame:
    """``file_path, file_size`` of every file under ``path``, empty ones too;
    no content is read.  The names come from Spark's own listing of the folder
    (a scan leaves empty files out); names that begin with ``_`` or ``.`` are
    not data."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    names = spark.createDataFrame([(f,) for f in files.inputFiles()], "file_path string")
    sizes = files.select(_canonical(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("file_size"))
    listed = names.select(_canonical(F.col("file_path")).alias("file_path")).join(sizes, "file_path", "left")
    name = F.element_at(F.split("file_path", "/"), -1)
    return listed.filter(~name.startswith("_") & ~name.startswith(".")).select(
        "file_path", F.coalesce("file_size", F.lit(0)).alias("file_size"))


def new_files(listing: DataFrame, log: DataFrame | None) -> DataFrame:
    """Listed files that no earlier run has logged: an anti-join of listings,
    before any file is opened."""
    if log is None:
        return listing
    return listing.join(log.select("file_path").distinct(), "file_path", "left_anti")


def _folder_numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the complete ``name=N`` folders of ``path``, ascending."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(where):
        return []
    found = [st.getPath() for st in fs.listStatus(where) if st.getPath().getName().startswith(f"{name}=")]
    return sorted(int(p.getName().split("=")[1]) for p in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


SOURCE_LOG = "path string, timestamp long, batchId long"


def source_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file_path, entry``: every file that the stream with this checkpoint has
    taken, and the number of the log entry that holds it (the stream's own log;
    compacted entries repeat older ones)."""
    lines = spark.read.text(f"{checkpoint}/sources/0")
    parsed = lines.select(F.from_json("value", SOURCE_LOG).alias("e")).filter(F.col("e.path").isNotNull())
    return parsed.select(_canonical(F.col("e.path")).alias("file_path"), F.col("e.batchId").alias("entry")).distinct()


def ingest_new(spark: SparkSession, path: str, schema: T.StructType, state: str, multiline: bool = False,
               max_files: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """One incremental run: rows of the new files, and the run's totals.

    A file stream finds the new files: its checkpoint under ``state`` is the log
    of files taken, which no run lists or collects, and a run takes them in
    batches of ``max_files``.  Every batch's rows and counters are written
    under the run's number, so a run that broke off goes on where it was.

        state/checkpoint        the stream's log
        state/rows/run=R/...    rows of run R, by batch
        state/files/run=R       counters of each file of run R; makes it complete

    A file without any parsable record, an empty one included, is an error.  The
    next run reads such files again, up to ``max_files`` of them at a time, the
    longest waiting first.  Raises if there are no files at all, or new ones but
    no valid record in them.
    """
    runs = _folder_numbers(spark, f"{state}/files", "run")
    run = runs[-1] + 1 if runs else 0
    before = spark.read.parquet(f"{state}/files") if runs else None
    rows_path, checkpoint, files_path = f"{state}/rows/run={run}", f"{state}/checkpoint", f"{state}/files/run={run}"

    def keep(rows: DataFrame, batch: int) -> None:
        _with_file(rows).write.mode("overwrite").parquet(f"{rows_path}/batch={batch}")

    scan = (spark.readStream.schema(_scan_schema(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", multiline).option("maxFilesPerTrigger", max_files)
            .option("maxFileAge", "36500d")  # old files that arrive late are new, too
            .option("recursiveFileLookup", True))  # folder names are no columns
    (scan.json(path).select(*_scan_schema(schema).names, "_metadata").writeStream
     .foreachBatch(keep).option("checkpointLocation", checkpoint)
     .trigger(availableNow=True).start().awaitTermination())

    # files of earlier runs without a good record are tried again
    retried = None
    if before is not None:
        last = before.groupBy("file_path").agg(F.max_by("status", "run").alias("status"), F.min("run").alias("since"))
        waiting = last.filter("status = 'error'").orderBy("since", "file_path").limit(max_files).select("file_path")
        again = [r.file_path for r in waiting.collect()]
        if again:
            keep(spark.read.schema(_scan_schema(schema)).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
                 .option("multiLine", multiline).json(again), -1)
            retried = spark.createDataFrame([(f,) for f in again], "file_path string").withColumn("entry", F.lit(-1).cast("long"))

    known = before.agg(F.max("entry")).first()[0] if before is not None else None
    taken = _taken(spark, checkpoint)
    listing = retried if retried is not None else spark.createDataFrame([], "file_path string, entry long")
    if taken is not None:
        listing = listing.unionByName(taken.filter(F.col("entry") > (-1 if known is None else known)))
    if before is None and not listing.limit(1).count():
        raise ValueError(f"no files found in {path}")
    rows = _written_rows(spark, rows_path, schema)
    sizes = rows.groupBy("file_path").agg(F.max("file_size").alias("file_size"))
    sized = listing.join(sizes, "file_path", "left").withColumn("file_size", F.coalesce("file_size", F.lit(0)))
    stats = ingest_stats(rows, sized).join(listing, "file_path").withColumn("run", F.lit(run))
    stats.write.mode("overwrite").parquet(files_path)
    done = spark.read.schema(stats.schema).parquet(files_path)
    counts = done.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "processed").alias("good")).first()
    if counts.n and not counts.good:
        raise ValueError(f"no valid JSON data in any of {counts.n} new files")
    earlier = 0 if before is None else before.filter("status = 'processed'").count()
    return rows, ingest_totals(done, earlier)


def _with_file(rows: DataFrame) -> DataFrame:
    return rows.select(*[c for c in rows.columns if c != "_metadata"], _canonical(F.col("_metadata.file_path")).alias("file_path"),
                       F.col("_metadata.file_size").alias("file_size"))


def _written_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of a run, all batches; none if the run took no file."""
    full = T.StructType([*_scan_schema(schema).fields, T.StructField("file_path", T.StringType()), T.StructField("file_size", T.LongType())])
    batches = [f"{path}/batch={b}" for b in _folder_numbers(spark, path, "batch")]
    return spark.read.schema(full).parquet(*batches) if batches else spark.createDataFrame([], full)


def _taken(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    where = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/sources/0")
    return source_log(spark, checkpoint) if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where) else None


def ingest_stats(scan: DataFrame, listing: DataFrame) -> DataFrame:
    """Per listed file: records, parse errors, bytes, status.

    Counts start from the listing, so a file that yields no row (an empty one)
    is there with 0 records.  A file without any parsable record is an error.
    ``scan`` should be a saved layer: Spark refuses to read nothing but the
    corrupt-record column from raw JSON.
    """
    counts = scan.groupBy("file_path").agg(
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col(CORRUPT).isNotNull()).alias("error_records"))
    records, errors = F.coalesce("records", F.lit(0)), F.coalesce("error_records", F.lit(0))
    return listing.join(counts, "file_path", "left").select(
        "file_path", records.alias("records"), errors.alias("error_records"), F.col("file_size").alias("bytes"),
        F.when(records == errors, "error").otherwise("processed").alias("status"))


def ingest_totals(stats: DataFrame, skipped_files: int = 0) -> DataFrame:
    """Counts of a run; ``skipped_files`` were processed by earlier ones."""
    return stats.agg(
        F.count_if(F.col("status") == "processed").alias("processed_files"),
        F.count_if(F.col("status") == "error").alias("error_files"),
        F.lit(skipped_files).cast("long").alias("skipped_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.col("records") - F.col("error_records")), F.lit(0)).alias("records"),
        F.coalesce(F.sum("error_records"), F.lit(0)).alias("error_records"))


def with_hour_partitions(df: DataFrame, ts: str) -> DataFrame:
    """UTC year/month/day/hour partition columns for a lake layout."""
    t = F.col(ts)
    return df.withColumns({"year": F.year(t), "month": F.month(t), "day": F.dayofmonth(t), "hour": F.hour(t)})


def write_lake(df: DataFrame, path: str, ts: str, mode: str = "append") -> None:
    """Hourly-partitioned JSON lake (year=/month=/day=/hour=).

    Rows are range-partitioned on the timestamp first: each writer task covers
    a contiguous time span, so it opens files for only a few hours (files ~
    hours + tasks, not hours x tasks), and a hot hour is still split across
    several tasks because the ranges are cut on the timestamp itself.
    """
    # as many ranges as the session's shuffle partitions; AQE merges small ones
    ranged = df.repartitionByRange(F.col(ts)).sortWithinPartitions(ts)
    (with_hour_partitions(ranged, ts).write.mode(mode).partitionBy("year", "month", "day", "hour")
     .option("ignoreNullFields", "false").json(path))


def existing_inputs(spark: SparkSession, paths: list[str]) -> list[str]:
    """Keep the input locations that exist (metadata calls only); raise if none."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    keep = []
    for p in paths:
        hp = jvm.org.apache.hadoop.fs.Path(p)
        if hp.getFileSystem(conf).exists(hp):
            keep.append(p)
    if not keep:
        raise ValueError(f"none of the input locations exist: {paths}")
    return keep


def csv_to_parquet(spark: SparkSession, src: str, dst: str, schema: T.StructType | None = None,
                   row_cap: int | None = None) -> None:
    """Gzip/plain CSV (header) -> snappy parquet.  All rows, unless the caller
    asks for a bounded extract of any ``row_cap`` rows."""
    r = spark.read.option("header", True)
    r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
    df = r.csv(src)
    if row_cap is not None:
        df = df.limit(row_cap)
    df.write.mode("overwrite").option("compression", "snappy").parquet(dst)


def jdbc_source(spark: SparkSession, url: str, table: str, partition_column: str | None = None,
                lower: int | None = None, upper: int | None = None, partitions: int = 8,
                properties: dict | None = None) -> DataFrame:
    """Relational table/query source, read in parallel ranges of ``partition_column``."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
             .option("upperBound", upper).option("numPartitions", partitions))
    return r.load()


def schema_only(df: DataFrame) -> T.StructType:
    """Column names and types without reading rows."""
    return df.schema
