"""A keyed table in hash buckets, merged batch by batch.

Keys are dealt to a fixed number of buckets by hash.  A merge reads and rewrites
only the buckets that hold keys of its batch; a manifest then names, for every
bucket, the merge whose files are current:

    data/version=V/bucket=B/   rows of bucket B as of merge V
    manifest/version=V/        ``bucket, written``: where each bucket's rows are

A merge is in force once its manifest is complete.  One that failed before that
left files that no manifest names; its replay overwrites them.  A merge that is
in force already is not repeated, so replaying a batch changes nothing, and
files that readers may hold are never rewritten.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Manifests that stay readable for readers under way, with the files they name.
KEPT_VERSIONS = 3
MANIFEST = "bucket int, written long, buckets int"


def _path(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def complete_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete ``version=N`` folders of ``path``, ascending."""
    root, fs = _path(spark, path)
    if not fs.exists(root):
        return []
    found = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith("version=")]
    return sorted(int(p.getName().split("=")[1]) for p in found
                  if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


class KeyedStore:
    """The table under ``path`` with the given key columns.

    ``combine`` turns the rows of some keys, stored and new together, into one
    row a key; it must not depend on how rows are grouped into calls.  The
    number of buckets is fixed by the first merge.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], combine: Callable[[DataFrame], DataFrame],
                 buckets: int = 64) -> None:
        self.spark, self.path, self.keys, self.combine, self._buckets = spark, path, keys, combine, buckets

    def versions(self) -> list[int]:
        return complete_versions(self.spark, f"{self.path}/manifest")

    def manifest(self, before: int | None = None) -> dict[int, int]:
        """Bucket -> the merge that wrote its rows (one entry a bucket), in the
        newest manifest, or the newest below ``before``."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={known[-1]}").collect()
        self._buckets = rows[0].buckets if rows else self._buckets
        return {r.bucket: r.written for r in rows}

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self._buckets)).cast("int")

    def _read(self, where: dict[int, int]) -> DataFrame | None:
        """Rows of these buckets, from the files that the manifest names."""
        if not where:
            return None
        folders = [f"{self.path}/data/version={v}/bucket={b}" for b, v in sorted(where.items())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders).drop("version", "bucket")

    def snapshot(self, before: int | None = None) -> DataFrame | None:
        """All rows after the newest merge (below ``before``); None before the first."""
        return self._read(self.manifest(before))

    def lookup(self, keys: DataFrame) -> DataFrame | None:
        """Stored rows of the given keys; only the buckets that can hold them are read."""
        where = self.manifest()
        asked = keys.select(*self.keys).distinct()
        touched = {r[0] for r in asked.select(self.bucket_of()).distinct().collect()}
        rows = self._read({b: v for b, v in where.items() if b in touched})
        if rows is None:
            whole = self._read(where)
            return whole.limit(0) if whole is not None else None
        return rows.join(asked, self.keys, "left_semi")

    def merge(self, increment: DataFrame, version: int) -> list[int]:
        """Merge the rows of ``increment`` as ``version`` and return the buckets
        that were rewritten; none if that merge is in force already."""
        if version in self.versions():
            return []
        where = self.manifest(version)
        new = self.combine(increment).withColumn("bucket", self.bucket_of())
        staged = f"{self.path}/incoming/version={version}"
        new.write.mode("overwrite").parquet(staged)
        new = self.spark.read.schema(new.schema).parquet(staged)
        touched = sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most the number of buckets
        if touched:
            old = self._read({b: where[b] for b in touched if b in where})
            rows = new.drop("bucket") if old is None else self.combine(old.select(*new.columns[:-1]).unionByName(new.drop("bucket")))
            (rows.withColumn("bucket", self.bucket_of()).repartition("bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}"))
        where |= {b: version for b in touched}
        (self.spark.createDataFrame([(b, v, self._buckets) for b, v in sorted(where.items())], MANIFEST).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}"))
        self._forget(f"{self.path}/incoming", [version])
        self._clean()
        return touched

    def _clean(self) -> None:
        """Drop old manifests, and data that no kept manifest names."""
        known = self.versions()
        self._forget(f"{self.path}/manifest", known[:-KEPT_VERSIONS])
        named: set[int] = set()
        for v in known[-KEPT_VERSIONS:]:
            named |= set(self.manifest(v + 1).values())
        self._forget(f"{self.path}/data", [v for v in complete_versions(self.spark, f"{self.path}/data")
                                           if v not in named and v <= known[-1]])

    def _forget(self, path: str, versions: list[int]) -> None:
        for v in versions:
            gone, fs = _path(self.spark, f"{path}/version={v}")
            fs.delete(gone, True)
