"""Tables of plain Parquet: overwrite, append, keyed merge and replacement, written by Spark's own modes.

A table is a folder that any Parquet reader can read. Its partitions are the columns asked for, or else ``buckets`` hash
buckets of the keys (column ``_bucket``), so that a merge need not look for the partitions that hold its keys. A merge is a
join of the touched partitions with the batch, written with dynamic partition overwrite: Spark writes to a staging folder
and swaps in whole partitions when the job has succeeded, the others are neither read nor written. A large merge runs such a
job per group of buckets, so that the shuffles and staged files of one group are on the disk at a time; if it breaks off, the
groups before are merged, and repeating it does the rest. Repeating a merge, or an append with keys, gives the same rows, which
is all that a replayed micro-batch needs.

Beside the table, ``<path>_operations`` is a small Parquet log for people (``info``, ``history``) and keeps the schema; no
read depends on it for rows. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.session import discard, shuffles_deleted, stage

BUCKET = "_bucket"
#: Rows that were appended without keys.
NO_BUCKET = -1
OPERATIONS = "version int, operation string, timestamp string, rows bigint, batch_id string, schema string, keys string"


class DuplicateSourceKeys(ValueError):
    """The batch holds a business key more than once, so a merge would be ambiguous."""


class LakeTable:
    def __init__(self, spark: SparkSession, path: str, partition_by: list[str] | None = None, buckets: int = 16, group_bytes: int = 32 << 20):
        """``buckets`` is used without ``partition_by`` and must stay the same; choose it so that one bucket is about a GB.

        A merge of more than ``group_bytes`` (old files and batch) rewrites a group of buckets at a time.
        """
        self.spark, self.path, self.buckets, self.group_bytes = spark, path.rstrip("/"), buckets, group_bytes
        self.bucketed = not partition_by
        self.partition_by = list(partition_by or [BUCKET])

    # -- what is there -----------------------------------------------------------------------

    def _is_there(self, path: str) -> bool:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder)

    def exists(self) -> bool:
        return self._is_there(f"{self.path}_operations")

    def _log(self) -> DataFrame:
        return self.spark.read.schema(OPERATIONS).parquet(f"{self.path}_operations")

    def history(self, limit: int = 10) -> list[dict]:
        if not self.exists():
            return []
        return [r.asDict() for r in self._log().orderBy(F.desc("version")).limit(limit).collect()]

    def _record(self, operation: str, schema: T.StructType, rows: int, batch_id: str | None, keys: list[str] | None) -> dict:
        last = self.history(1)
        row = {
            "version": last[0]["version"] + 1 if last else 1, "operation": operation, "timestamp": datetime.now(timezone.utc).isoformat(),
            "rows": rows, "batch_id": batch_id, "schema": schema.json(), "keys": json.dumps(keys) if keys else None,
        }
        self.spark.createDataFrame([row], OPERATIONS).coalesce(1).write.mode("append").parquet(f"{self.path}_operations")
        return row

    def _state(self) -> tuple[T.StructType | None, list[str] | None]:
        """Schema, and the keys whose hash is a row's bucket."""
        last = self.history(1)
        return (T.StructType.fromJson(json.loads(last[0]["schema"])), json.loads(last[0]["keys"] or "null")) if last else (None, None)

    def _load(self, schema: T.StructType) -> DataFrame:
        """All rows, with the bucket where there is one."""
        whole = T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())]) if self.bucketed else schema
        return self.spark.read.schema(whole).parquet(self.path) if self._is_there(self.path) else self.spark.createDataFrame([], whole)

    def read(self) -> DataFrame:
        schema, _ = self._state()
        if schema is None:
            raise FileNotFoundError(self.path)
        return self._load(schema).select(*schema.fieldNames())

    def info(self) -> dict:
        """Row and column counts, columns, latest version and the last five operations."""
        recent = self.history(5)
        if not recent:
            return {"exists": False, "path": self.path}
        df = self.read()
        return {
            "exists": True,
            "path": self.path,
            "row_count": df.count(),
            "column_count": len(df.columns),
            "columns": df.columns,
            "latest_version": recent[0]["version"],
            "recent_operations": [{k: r[k] for k in ("version", "operation", "timestamp")} for r in recent],
        }

    # -- writing -----------------------------------------------------------------------------

    def _with_bucket(self, df: DataFrame, keys: list[str] | None) -> DataFrame:
        if not self.bucketed:
            return df
        number = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int") if keys else F.lit(NO_BUCKET)
        return df.withColumn(BUCKET, number)

    def _widen(self, df: DataFrame, old: T.StructType | None) -> DataFrame:
        """Fit a batch to the table: add its missing columns as NULL, cast the shared ones, keep new ones."""
        if old is None:
            return df
        have = set(df.columns)
        shared = [(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in old]
        return df.select(*shared, *[c for c in df.columns if c not in old.fieldNames()])

    def _write(self, df: DataFrame, mode: str, dynamic: bool = False) -> int:
        """Write and count in one job; each partition's rows are gathered first, and split again where they are many."""
        seen = Observation()
        out = df.hint("rebalance", *self.partition_by).observe(seen, F.count(F.lit(1)).alias("rows"))
        with shuffles_deleted(self.spark):
            out.write.mode(mode).option("compression", "zstd").option("partitionOverwriteMode", "dynamic" if dynamic else "static").partitionBy(*self.partition_by).parquet(self.path)
        return int(seen.get["rows"])

    def _plain(self, df: DataFrame) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in df.schema if f.name != BUCKET])

    def overwrite(self, df: DataFrame, keys: list[str] | None = None, batch_id: str | None = None) -> dict:
        """Full refresh; the schema may change."""
        out = self._with_bucket(df, keys)
        return self._record("overwrite", self._plain(out), self._write(out, "overwrite"), batch_id, keys)

    def append(self, df: DataFrame, idempotency_keys: list[str] | None = None, batch_id: str | None = None) -> dict:
        """Add rows. With ``idempotency_keys`` rows already present under these columns are skipped; NULLs count as equal."""
        old, own = self._state()
        if old is None:
            return self.overwrite(df, idempotency_keys, batch_id)
        own = own or idempotency_keys
        out = self._with_bucket(self._widen(df, old), own)
        if idempotency_keys:
            out = out.join(*_matching(out, self._load(old), idempotency_keys, null_safe=True), "left_anti")
        rows = self._write(out, "append")
        return self._record("append", self._plain(out), rows, batch_id, own) if rows else self.history(1)[0] | {"rows": 0}

    def merge(
        self, df: DataFrame, keys: list[str], update_columns: list[str] | None = None, null_safe: bool = False, batch_id: str | None = None,
        sources: Sequence[DataFrame] = (),
    ) -> dict:
        """Upsert on ``keys``: update all (or the given) columns where matched, insert otherwise.

        NULL keys never match unless ``null_safe``. The batch is written once, so its source is read a single time; a key
        that occurs twice in it is an error. ``sources`` are written frames below ``df`` to discard when it has been read.
        """
        return self._change("merge", df, keys, update_columns, null_safe, batch_id, sources)

    def replace(self, df: DataFrame, keys: list[str], batch_id: str | None = None, sources: Sequence[DataFrame] = ()) -> dict:
        """Put the rows of ``df`` in the place of all rows that share one of their ``keys``.

        Keys may repeat in ``df``: a history rebuilt for some keys replaces all of their versions, also those that the
        rebuild no longer has. NULL keys count as equal. ``sources`` are as in ``merge``.
        """
        return self._change("replace", df, keys, None, True, batch_id, sources)

    def _change(self, operation: str, df: DataFrame, keys: list[str], update_columns: list[str] | None, null_safe: bool, batch_id: str | None, sources: Sequence[DataFrame]) -> dict:
        (old, own), seen = self._state(), Observation()
        own = own or keys
        shaped = self._with_bucket(self._widen(df, old), own)
        batch = stage(shaped.observe(seen, F.count(F.lit(1)).alias("rows"), F.collect_set(F.col(BUCKET) if self.bucketed else F.lit(None)).alias("buckets")), "batch")
        discard(*sources)
        try:
            if operation == "merge":
                self._reject_duplicates(batch, keys)
            if old is None:
                self._write(batch, "overwrite")
            else:
                buckets = seen.get["buckets"] if set(own) <= set(keys) else range(self.buckets)  # equal keys share a bucket
                self._rewrite(batch, old, keys, update_columns, null_safe, list(buckets), own)
            return self._record("overwrite" if old is None else operation, self._plain(batch), int(seen.get["rows"]), batch_id, own)
        finally:
            discard(batch)

    def _rewrite(self, batch: DataFrame, old: T.StructType, keys: list[str], update_columns: list[str] | None, null_safe: bool, buckets: list[int], own: list[str]) -> None:
        target = self._load(old)
        if self.bucketed:
            touched = [{BUCKET: b} for b in (*buckets, NO_BUCKET)]
        else:  # the partitions that hold a key of the batch, from the key and partition columns alone
            slim = target.select(*dict.fromkeys([*keys, *self.partition_by]))
            hit = slim.join(*_matching(slim, batch, keys, null_safe), "left_semi").unionByName(batch, allowMissingColumns=True)
            touched = [r.asDict() for r in hit.select(*self.partition_by).distinct().collect()]  # one row per partition
        if not touched:
            return
        # a key keeps its bucket, but may change its partition, and other keys may lie in any bucket
        may_empty = [{BUCKET: NO_BUCKET}] if self.bucketed and set(own) <= set(keys) else touched
        before = self._file_names(target, may_empty)
        for part, rows in self._groups(touched, batch, buckets, keys, update_columns, own):
            rewritten = target.filter(_within(part))
            rewritten = rewritten.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in batch.schema if f.name not in rewritten.columns])
            kept = rewritten.join(*_matching(rewritten, rows, keys, null_safe), "left_anti")
            arriving = rows if update_columns is None else _partial_update(rewritten, rows, keys, update_columns, null_safe)
            self._write(kept.select(*batch.columns).unionByName(arriving.select(*batch.columns)), "overwrite", dynamic=True)
        for name in before & self._file_names(self._load(old), may_empty):  # its partition has lost all rows, so nothing took its place
            file = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(name))
            file.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(file, False)

    def _groups(self, touched: list[dict], batch: DataFrame, buckets: list[int], keys: list[str], update_columns: list[str] | None, own: list[str]) -> list[tuple[list[dict], DataFrame]]:
        """(partitions, their rows of the batch) to rewrite at a time: all, or of a large table the buckets that ``group_bytes`` hold.

        Only where equal keys share a bucket, so that a group's old rows can match no other rows of the batch.
        """
        alone = self.bucketed and set(own) <= set(keys) and update_columns is None and not self._is_there(f"{self.path}/{BUCKET}={NO_BUCKET}")
        n = min(len(buckets), -(-(self._bytes(self.path) + self._bytes(batch.written_to)) // self.group_bytes)) if alone else 1
        if n <= 1:
            return [(touched, batch)]
        groups = [sorted(buckets)[j::n] for j in range(n)]
        return [([{BUCKET: b} for b in g], batch.filter(F.col(BUCKET).isin(g))) for g in groups]

    def _bytes(self, path: str) -> int:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength() if self._is_there(path) else 0

    @staticmethod
    def _file_names(table: DataFrame, partitions: list[dict]) -> set[str]:
        """The files of some partitions, a few per partition."""
        return {r[0] for r in table.filter(_within(partitions)).select("_metadata.file_path").distinct().collect()}

    @staticmethod
    def _reject_duplicates(df: DataFrame, keys: list[str]) -> None:
        present = df.select(*keys).dropna(subset=keys)
        if not present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
            raise DuplicateSourceKeys(f"the batch repeats values of {keys}")


def _within(partitions: list[dict]) -> Column:
    """Filter on partition columns, which Spark answers from the folders' names. Of several columns and many partitions it
    asks for each column alone; what that adds is rewritten as it is."""

    def among(name: str) -> Column:
        values = {p[name] for p in partitions}
        some = F.col(name).isin([v for v in values if v is not None]) if values - {None} else F.lit(False)
        return some | F.col(name).isNull() if None in values else some

    names = list(partitions[0])
    if len(names) == 1 or len(partitions) > 50:
        return reduce(Column.__and__, map(among, names))
    return reduce(Column.__or__, (reduce(Column.__and__, (F.col(c).eqNullSafe(F.lit(v)) for c, v in p.items())) for p in partitions))


def _matching(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> tuple[DataFrame, Column]:
    """The key columns of ``right`` under other names, and the join condition."""
    slim = right.select(*[F.col(k).alias(f"_m_{k}") for k in keys])
    on = F.lit(True)
    for k in keys:
        on = on & (left[k].eqNullSafe(F.col(f"_m_{k}")) if null_safe else left[k] == F.col(f"_m_{k}"))
    return slim, on


def _partial_update(target: DataFrame, source: DataFrame, keys: list[str], update_columns: list[str], null_safe: bool) -> DataFrame:
    """Source rows; where a target row matches, it keeps its columns outside ``update_columns``."""
    old = target.select(*[F.col(c).alias(f"_old_{c}") for c in target.columns], F.lit(True).alias("_matched"))
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(k).eqNullSafe(F.col(f"_old_{k}")) if null_safe else F.col(k) == F.col(f"_old_{k}"))
    joined = source.join(old, on, "left")
    fixed = [c for c in source.columns if c not in update_columns and c not in keys and c != BUCKET]
    kept = [F.when(F.col("_matched"), F.col(f"_old_{c}")).otherwise(F.col(c)).alias(c) if c in fixed else F.col(c) for c in source.columns]
    return joined.select(*kept)
