"""Structured Streaming jobs.

Each job wraps operators already tested in batch: ``readStream`` -> the same
DataFrame functions -> ``writeStream``.  Sources are Kafka in production and a
file source in tests (same downstream code).  Sinks write per micro-batch into
``batch_id=N`` partitions with dynamic partition overwrite, so a batch replayed
after a failure replaces its own output instead of duplicating it; progress is
tracked in a checkpoint on the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from tidemark.operators import features as FE
from tidemark.operators import validation as V
from tidemark.operators.envelope import envelope_decode
from tidemark.operators.silver import first_per_key
from tidemark.sources.lake import with_hour_partitions
from tidemark.streaming.key_filters import KeyFilters
from tidemark.streaming.keyed_store import KeyedStore

# --- fixed values -------------------------------------------------------------
FEATURE_TRIGGER = "4 seconds"
LAKE_TRIGGER = "60 seconds"
FEATURE_WATERMARK = "1 minute"
SESSION_GAP = "24 hours"
# Buckets of a new online store.
ONLINE_BUCKETS = 32
# -------------------------------------------------------------------------------


def kafka_source(spark: SparkSession, topics: list[str], bootstrap: str,
                 starting: str = "latest", max_offsets: int | None = None) -> DataFrame:
    """Value-only UTF-8 records from existing topics (requires the Kafka connector jar)."""
    if not topics:
        raise ValueError("no input topics")
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", ",".join(topics)).option("startingOffsets", starting)
         .option("failOnDataLoss", "false"))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", max_offsets)
    return r.load().select(F.col("topic"), F.col("timestamp"), F.col("value").cast("string").alias("value"))


def file_source(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files: int | None = None, max_bytes: int | None = None) -> DataFrame:
    """Files of a folder; a micro-batch takes ``max_files`` files, or as many as
    have ``max_bytes``, at least one."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        r = r.option("maxBytesPerTrigger", max_bytes)
    return r.load(path)


def _write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "parquet") -> None:
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write
     .mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").format(fmt).save(path))


def start_validation_routing(stream: DataFrame, valid_path: str, invalid_path: str, checkpoint: str,
                             keep: list[str], trigger: dict | None = None, metrics_path: str | None = None) -> StreamingQuery:
    """Validate each record once and route by verdict to two sinks.

    The schemas that a batch's records begin with are found first, by a pass
    that only cuts texts; the verdict is then a column, so the JSON is parsed
    once a record, and the batch is persisted so that both filtered writes read
    the same rows.  Given ``metrics_path``, each batch adds a row of counters and
    its processing time to the table there (``live_metrics``); a replayed batch
    replaces its row.
    """

    def route(batch: DataFrame, batch_id: int) -> None:
        began = time.monotonic()
        verdicts = V.validate_dynamic(batch, keep=keep + ["value"], known=V.record_heads(batch)).persist()
        try:
            _write_batch(verdicts.filter(F.col("valid") == V.VALID), valid_path, batch_id)
            _write_batch(V.invalid_record_json(verdicts.filter(F.col("valid") == V.INVALID)), invalid_path, batch_id)
            if metrics_path is not None:
                n = verdicts.agg(F.count_if(F.col("valid") == V.VALID), F.count_if(F.col("valid") == V.INVALID)).first()
                _write_batch(batch.sparkSession.createDataFrame(
                    [(n[0], n[1], 1000.0 * (time.monotonic() - began), _dt.datetime.now(_dt.timezone.utc))], METRICS).coalesce(1),
                    metrics_path, batch_id)
        finally:
            verdicts.unpersist()

    w = stream.writeStream.foreachBatch(route).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


METRICS = "success_count long, failure_count long, processing_ms double, finished_at timestamp"


def live_metrics(spark: SparkSession, path: str, last: int | None = None) -> DataFrame:
    """Running totals of the batches finished so far (the ``last`` ones, if
    given): records that passed and failed, and milliseconds per 1000 records."""
    rows = spark.read.schema(f"{METRICS}, batch_id long").parquet(path)
    if last is not None:
        rows = rows.orderBy(F.desc("batch_id")).limit(last)
    records = F.sum(F.col("success_count") + F.col("failure_count"))
    return rows.agg(F.count(F.lit(1)).alias("batches"), F.sum("success_count").alias("success_count"),
                    F.sum("failure_count").alias("failure_count"),
                    F.when(records > 0, 1000 * F.sum("processing_ms") / records).alias("ms_per_1000"))


def start_late_split(events: DataFrame, ts: str, on_time_path: str, late_path: str, checkpoint: str, delay: str = FEATURE_WATERMARK,
                     trigger: dict | None = None) -> StreamingQuery:
    """Write rows behind the watermark to a table of their own.

    The watermark of a batch is the newest ``ts`` of all batches before it, less
    ``delay``; it is saved with each batch (``<late_path>_marks``), so a replayed
    batch splits as it did before.  Rows without a time are on time: no rule
    says that they are late.  Every row goes to one of the tables.
    """
    marks = f"{late_path}_marks"

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.persist()
        try:
            known = [b for b in batch_numbers(spark, marks) if b < batch_id]
            before = spark.read.parquet(f"{marks}/batch_id={known[-1]}").first().newest if known else None
            bound = F.lit(before) - F.expr(f"INTERVAL {delay}") if before is not None else F.lit(None).cast("timestamp")
            late = F.coalesce(F.col(ts) < bound, F.lit(False))
            _write_batch(rows.filter(~late), on_time_path, batch_id)
            _write_batch(rows.filter(late).withColumn("watermark", bound), late_path, batch_id)
            newest = rows.agg(F.max(ts)).first()[0]
            newest = max(x for x in (before, newest) if x is not None) if (before, newest) != (None, None) else None
            _write_batch(spark.createDataFrame([(newest,)], "newest timestamp").coalesce(1), marks, batch_id)
        finally:
            rows.unpersist()

    w = events.writeStream.foreachBatch(split).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_feature_ingest(validated: DataFrame, offline_path: str, checkpoint: str, keep: list[str],
                         trigger: dict | None = None, online_path: str | None = None) -> StreamingQuery:
    """Per micro-batch: decode validated records, build feature rows, append to the
    offline store (idempotent per batch) and, given ``online_path``, merge the
    newest row per entity into the online store.  ``activity_count`` is per
    batch, as in the source system; ``session_activity_stream`` gives the
    stateful form."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # the per-session count reads the batch twice (aggregate + join back):
        # keep the decoded batch once instead of re-reading the source
        rows = envelope_decode(batch, keep=keep).persist()
        try:
            feats = FE.preprocess_batch(rows, keep=keep)
            _write_batch(FE.offline_rows(feats), offline_path, batch_id)
            if online_path is not None:
                spark = batch.sparkSession
                done = (spark.read.parquet(offline_path).filter(F.col("batch_id") == batch_id)
                        .drop("batch_id", "created_timestamp"))
                online_merge(done, online_path, batch_id)
        finally:
            rows.unpersist()

    w = validated.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": FEATURE_TRIGGER})).start()


def online_store(spark: SparkSession, path: str, buckets: int = ONLINE_BUCKETS) -> KeyedStore:
    """The online store: the newest row per entity, in hash buckets."""
    return KeyedStore(spark, path, FE.ENTITY_KEYS, FE.latest_per_key, buckets)


def online_snapshot(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All rows of the online store after its newest merge (below ``before``)."""
    return online_store(spark, path).snapshot(before)


def online_merge(increment: DataFrame, path: str, version: int) -> list[int]:
    """Merge the newest row per entity of ``increment`` into the online store;
    the buckets that were rewritten.  A replayed version changes nothing."""
    return online_store(increment.sparkSession, path).merge(increment, version)


def materialise_hourly(spark: SparkSession, offline_path: str, online_path: str, until: _dt.datetime) -> None:
    """Merge the offline rows after the last materialised instant, up to
    ``until``, into the online store.  The instant is the version's number
    (epoch microseconds), so it is saved with the data."""
    known = online_store(spark, online_path).versions()
    end = int(until.replace(tzinfo=_dt.timezone.utc).timestamp() * 1_000_000)
    if known and known[-1] >= end:
        return
    t = F.unix_micros("event_timestamp")
    rows = spark.read.parquet(offline_path).drop("batch_id", "created_timestamp").filter(t <= end)
    online_merge(rows.filter(t > known[-1]) if known else rows, online_path, end)


def start_dedup(events: DataFrame, path: str, checkpoint: str, key: str = "record_hash", order: str = "ingest_seq",
                trigger: dict | None = None) -> StreamingQuery:
    """Keep one row per key for good: the earliest batch's, and within a batch
    the one of the smallest ``order``.

    Each batch is reduced to its first rows.  The Bloom filters of earlier
    batches, kept in ``<path>_filters``, say which of them may hold any of its
    keys, and only their keys are read for the exact anti-join; a batch without
    a filter is read.  A replayed batch leaves its own rows out of that and
    replaces them.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        first = first_per_key(batch, [key], order).persist()
        try:
            fresh = first
            old = dedup_candidates(first, path, key, batch_id)
            if old:
                seen = spark.read.parquet(*[f"{path}/batch_id={b}" for b in old]).select(F.col(key).alias("_seen"))
                fresh = first.join(seen, first[key].eqNullSafe(F.col("_seen")), "left_anti")
            _write_batch(fresh.select(*batch.columns), path, batch_id)
            if batch_id in batch_numbers(spark, path):
                KeyFilters(spark, f"{path}_filters", key).add(spark.read.parquet(f"{path}/batch_id={batch_id}").select(key), batch_id,
                                                              batch_numbers(spark, f"{path}_filters"))
        finally:
            first.unpersist()

    w = events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def dedup_candidates(rows: DataFrame, path: str, key: str, batch_id: int) -> list[int]:
    """Batches before ``batch_id`` that may hold a key of ``rows``."""
    spark = rows.sparkSession
    written = [b for b in batch_numbers(spark, path) if b < batch_id]
    filtered = set(batch_numbers(spark, f"{path}_filters"))
    known = [b for b in written if b in filtered]
    return sorted([b for b in written if b not in filtered]
                  + KeyFilters(spark, f"{path}_filters", key).may_hold(rows.select(key), known))


def batch_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the ``batch_id=N`` folders of ``path``, ascending."""
    if not existing_folder(spark, path):
        return []
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [st.getPath().getName() for st in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    return sorted(int(n.split("=")[1]) for n in names if n.startswith("batch_id="))


def session_store(spark: SparkSession, path: str, key: str = "user_session", buckets: int = ONLINE_BUCKETS) -> KeyedStore:
    """Running count and last time per session, in hash buckets."""
    def add(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key).agg(F.sum("activity_count").alias("activity_count"), F.max("last_seen").alias("last_seen"))

    return KeyedStore(spark, path, [key], add, buckets)


def start_session_counter(events: DataFrame, path: str, checkpoint: str, key: str = "user_session",
                          ts: str = "event_timestamp", trigger: dict | None = None) -> StreamingQuery:
    """Running count and last time per session, merged into a keyed store.

    A batch is counted per session first, combined on the map side, so a hot
    session leaves each task as one row; only the buckets of these sessions are
    read and rewritten.  A replayed batch changes nothing.
    """

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        ones = batch.filter(F.col(key).isNotNull()).select(key, F.lit(1).cast("long").alias("activity_count"), F.col(ts).alias("last_seen"))
        session_store(batch.sparkSession, path, key).merge(ones, batch_id)

    w = events.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def live_sessions(spark: SparkSession, path: str, ttl_hours: int = 24, key: str = "user_session") -> DataFrame | None:
    """Sessions seen within ``ttl_hours`` of the newest event."""
    rows = session_store(spark, path, key).snapshot()
    if rows is None:
        return None
    newest = rows.agg(F.max("last_seen").alias("newest"))  # one row
    return rows.join(F.broadcast(newest), F.col("last_seen") >= F.col("newest") - F.expr(f"INTERVAL {ttl_hours} HOURS")).drop("newest")


def existing_folder(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def start_lake_sink(stream: DataFrame, ts: str, path: str, checkpoint: str,
                    trigger: dict | None = None) -> StreamingQuery:
    """Hourly-partitioned JSON lake sink (file sink: exactly-once via its log)."""
    out = with_hour_partitions(stream, ts)
    w = (out.writeStream.format("json").partitionBy("year", "month", "day", "hour")
         .option("path", path).option("checkpointLocation", checkpoint))
    return w.trigger(**(trigger or {"processingTime": LAKE_TRIGGER})).start()


def session_activity_stream(events: DataFrame, key: str = "user_session", ts: str = "event_timestamp",
                            gap: str = SESSION_GAP, watermark: str = FEATURE_WATERMARK) -> DataFrame:
    """Stateful per-session activity counts with a watermark, for append mode:
    a session is emitted (and its state evicted) once the watermark passes its
    end, so late rows beyond the watermark are dropped instead of reopening it."""
    return (events.withWatermark(ts, watermark)
            .groupBy(key, F.session_window(F.col(ts), gap).alias("s"))
            .agg(F.count(F.lit(1)).alias("activity_count"), F.max(ts).alias("last_seen")))


def dedup_stream(events: DataFrame, ts: str = "event_timestamp", watermark: str = FEATURE_WATERMARK,
                 key: str = "record_hash") -> DataFrame:
    """Drop replays of a record hash seen within the watermark delay, with
    state bounded by it.  Which copy of one micro-batch survives is not defined;
    ``start_dedup`` defines it."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([key])


def rate_stream(verdicts: DataFrame, ts: str, watermark: str = "10 seconds") -> DataFrame:
    """Success/failure counts per 1-second event-time window (late rows past the
    watermark are dropped from the counts)."""
    return (verdicts.withWatermark(ts, watermark).groupBy(F.window(ts, "1 second").alias("w"))
            .agg(F.count_if(F.col("valid") == V.VALID).alias("success_count"),
                 F.count_if(F.col("valid") != V.VALID).alias("failure_count"))
            .select(F.col("w.start").alias("window_start"), "success_count", "failure_count"))


def start_alert_stream(invalid_records: DataFrame, checkpoint: str, sink: str = "console",
                       trigger: dict | None = None) -> StreamingQuery:
    """Alert projection of the invalid topic to a console (or memory) sink."""
    alerts = V.invalid_alerts(invalid_records).withColumn("timestamp", F.current_timestamp())
    w = alerts.writeStream.format(sink).option("checkpointLocation", checkpoint)
    if sink == "memory":
        w = w.queryName("alerts")
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped as late (behind the watermark) by the query's stateful
    operators over the micro-batches that it still reports (a side count, not
    a sink; the session keeps ``spark.sql.streaming.numRecentProgressUpdates``)."""
    return int(sum(op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress or []
                   for op in p.get("stateOperators", [])))


def processing_ms_per_1000(query: StreamingQuery) -> float | None:
    """Mean processing time per 1000 input records over the recent micro-batches
    (from the query's own progress reports; no shared counters or locks)."""
    rows = ms = 0
    for p in query.recentProgress or []:
        n = p.get("numInputRows", 0)
        if n:
            rows += n
            ms += p.get("durationMs", {}).get("triggerExecution", 0)
    return 1000.0 * ms / rows if rows else None


SESSION_TTL_MS = 24 * 3600 * 1000
# Buckets of the counter's open sessions; fixed for the life of a checkpoint.
SESSION_BUCKETS = 1024
SESSION_OUT = "user_session string, activity_count long, last_seen timestamp, expired boolean"
# The state store that state variables with timers need.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class SessionCounter(StatefulProcessor):
    """Running count and last time of the sessions of one bucket.

    The bucket's open sessions are one state value, an Arrow table, so a batch
    costs one read and one write of state for each bucket that it touches, and
    no call for each session.  A bucket has one timer, at the time when the
    first of its sessions closes: once the watermark is a day past a session's
    last event.  Rows that come later begin the session anew.
    """

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("sessions", "due_ms long, sessions binary")

    def handleInputRows(self, key, rows, timerValues):
        import pyarrow as pa
        due, known = self._read()
        came = [pa.table({"user_session": pa.array(r["user_session"], pa.string()), "activity_count": pa.array(r["n"], pa.int64()),
                          "last_ms": pa.array(r["last_ms"], pa.int64())}) for r in rows]
        parts = [known.append_column("new", pa.array([False] * known.num_rows, pa.bool_()))]
        parts += [t.append_column("new", pa.array([True] * t.num_rows, pa.bool_())) for t in came]
        merged = pa.concat_tables(parts).group_by("user_session").aggregate(
            [("activity_count", "sum"), ("last_ms", "max"), ("new", "max")]).rename_columns(
            ["user_session", "activity_count", "last_ms", "new"])
        self._write(due, merged.drop_columns("new"))
        yield self._said(merged.filter(merged["new"]), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        import pyarrow.compute as pc
        _, known = self._read()
        closed = pc.less_equal(pc.add(known["last_ms"], SESSION_TTL_MS), timerValues.getCurrentWatermarkInMs())
        self._write(None, known.filter(pc.invert(closed)))   # the timer that rang is gone
        yield self._said(known.filter(closed), True)

    def close(self) -> None:
        pass

    def _read(self):
        """The time that the bucket's timer is set to, and its open sessions."""
        import pyarrow as pa
        if not self.open.exists():
            return None, pa.table({"user_session": pa.array([], pa.string()), "activity_count": pa.array([], pa.int64()),
                                   "last_ms": pa.array([], pa.int64())})
        due, saved = self.open.get()
        return due, pa.ipc.open_stream(saved).read_all()

    def _write(self, due, sessions) -> None:
        """Save the open sessions, and set the timer anew if another time is due."""
        import pyarrow as pa
        import pyarrow.compute as pc
        first = pc.min(sessions["last_ms"]).as_py()
        then = first + SESSION_TTL_MS if first is not None else None
        if due != then:
            if due is not None:
                self.handle.deleteTimer(due)
            if then is not None:
                self.handle.registerTimer(then)
        if then is None:
            self.open.clear()
            return
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, sessions.schema) as out:
            out.write_table(sessions)
        self.open.update((then, sink.getvalue().to_pybytes()))

    @staticmethod
    def _said(sessions, expired: bool):
        import pandas as pd
        said = sessions.select(["user_session", "activity_count"]).to_pandas()
        return said.assign(last_seen=pd.to_datetime(sessions["last_ms"].to_pandas(), unit="ms", utc=True), expired=expired)


def _combined(batches):
    """One row a session for each Arrow batch: rows counted, and the last time."""
    import pyarrow as pa
    for batch in batches:
        if batch.num_rows:
            t = pa.Table.from_batches([batch]).group_by("user_session").aggregate([("ms", "count"), ("ms", "max")])
            yield from t.rename_columns(["user_session", "n", "last_ms"]).select(
                ["user_session", "n", "last_ms"]).cast(pa.schema([("user_session", pa.string()), ("n", pa.int64()), ("last_ms", pa.int64())])).to_batches()


def session_counter_stream(events: DataFrame, watermark: str = FEATURE_WATERMARK) -> DataFrame:
    """Running activity count per session (update mode), closed a day of event
    time after its last event.

    Rows are combined before they reach the state, so a hot session comes as one
    row for some thousand events.  Sessions are dealt by hash to
    ``SESSION_BUCKETS`` buckets; a bucket's open sessions are kept together in the
    state store, checkpointed with the query and rewritten by each batch that
    touches the bucket; closed ones leave it.  Rows without a session or a time
    are not counted.  Sets the session's state store to the one that timers need.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    slim = (events.filter(F.col("user_session").isNotNull() & F.col("event_timestamp").isNotNull())
            .withWatermark("event_timestamp", watermark)
            .select("user_session", F.unix_millis("event_timestamp").alias("ms")))
    return (slim.mapInArrow(_combined, "user_session string, n long, last_ms long")
            .withColumn("bucket", F.pmod(F.xxhash64("user_session"), F.lit(SESSION_BUCKETS)))
            .groupBy("bucket")
            .transformWithStateInPandas(SessionCounter(), SESSION_OUT, "Update", "EventTime"))
