"""The serving tables: parquet folders partitioned by slot.

`replace` writes whole slots: running a slot again leaves the same rows, and no
row of an earlier run survives beside them.  `upsert` replaces single rows by key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from topicflow.schema import TABLES
from topicflow.session import run_dir
from topicflow.sinks import files


def _timestamp(at: datetime):
    if at.tzinfo is None:
        raise ValueError("the time needs a zone")
    return F.timestamp_micros(F.lit(int(at.timestamp() * 1_000_000)))


# Labels of folders that hold the rows of several batches.
_MERGED = "merged-"
# Rows of a file where a stream writes: Spark does not re-plan its batches by size.
_FILE_ROWS = 1_000_000
# Up to here Spark lists the given folders without a job of its own.
_FEW = 32


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{TABLES[name].name}"

    def stored(self, name: str, slots: Iterable[int] | None = None) -> DataFrame:
        """All stored rows and columns, expired ones too.

        A few slots are read from their own folders, so that a lookup in a table of
        many slots lists only those.  More are a filter on the partitions.
        """
        table, path = TABLES[name], self.path(name)
        wanted = None if slots is None else sorted(set(slots))
        folders = [path]
        if wanted is not None and len(wanted) <= _FEW:
            folders = sorted({f"{path}/{table.folder(s)}" for s in wanted})
        folders = [f for f in folders if files.exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], table.ddl)
        rows = self._listed(name, self.spark.read.schema(table.ddl).option("basePath", path).parquet(*folders))
        return rows if wanted is None else rows.where(F.col(table.slot).isin(wanted))

    def slots(self, name: str) -> list[int]:
        """The slots that have a folder, from their names alone, in order."""
        mark = f"{TABLES[name].partitions[0]}="
        return sorted(int(f.removeprefix(mark)) for f in files.children(self.spark, self.path(name)) if f.startswith(mark))

    def read(self, name: str, slots: Iterable[int] | None = None, as_of: datetime | None = None) -> DataFrame:
        """The visible rows: those younger than the table's retention at `as_of` (now)."""
        return self.visible(name, as_of, slots).select(*TABLES[name].columns)

    def visible(self, name: str, as_of: datetime | None = None, slots: Iterable[int] | None = None) -> DataFrame:
        """The rows of `read` with all stored columns."""
        rows = self.stored(name, slots)
        return rows if TABLES[name].ttl is None else rows.where(F.col("written_at") > self._limit(name, as_of))

    def replace(self, name: str, rows: DataFrame, written_at: datetime | None = None, n_rows: int | None = None) -> None:
        """Write rows, replacing every partition they fall into.  `n_rows`, if known, sets the number of files."""
        self._write(name, self._stamped(name, rows, written_at), n_rows)

    def upsert(self, name: str, rows: DataFrame, written_at: datetime | None = None, label: str | None = None) -> None:
        """Write rows by key: a stored row of the same key goes, the others of its slot stay.

        Copy on write: the folders the rows fall into are read, merged and written once,
        no others are looked at.  Of several rows of one key the greatest counts, so writing
        the same rows again changes nothing.  The incoming rows are staged first, as they
        are read twice.  Keys combine inside each task, so a crowded slot or key is spread out.

        In a table that streams write, `label` names the batch; the merged slot is one batch
        folder of that name, and older ones are dropped after it is there.  A run that broke off between
        the two is mended by the next one: copies of a row merge into one.
        """
        table = TABLES[name]
        if not table.key:
            raise ValueError(f"{name} has no key")
        if table.in_batches != (label is not None):
            raise ValueError("a label goes with the tables that streams write")
        if table.in_batches:
            rows = rows.withColumn("batch", F.lit(label))
        first, staged = table.partitions[0], run_dir(self.spark, "upsert")
        incoming = self._stamped(name, rows, written_at)
        try:
            incoming.write.parquet(staged)
            new = self.spark.read.schema(table.ddl).parquet(staged)
            # One row per folder.
            touched = sorted(r[0] for r in new.select(first).distinct().collect())
            if not touched:
                return
            before = {f: files.children(self.spark, f"{self.path(name)}/{first}={f}") for f in touched}
            rest = [c for c in new.columns if c not in table.key]
            both = self._in_folders(name, touched).withColumn("_new", F.lit(False)).unionByName(new.withColumn("_new", F.lit(True)))
            merged = both.groupBy(*table.key).agg(F.max_by(F.struct(*rest), F.struct("_new", *rest)).alias("_row"))
            merged = merged.select(*table.key, "_row.*")
            self._write(name, merged.withColumn("batch", F.lit(label)) if table.in_batches else merged)
            if table.in_batches:
                for folder, labels in before.items():
                    for old in labels:
                        if old.startswith("batch=") and old != f"batch={label}":
                            files.delete(self.spark, f"{self.path(name)}/{first}={folder}/{old}")
        finally:
            files.delete(self.spark, staged)

    def _in_folders(self, name: str, values: Iterable) -> DataFrame:
        """The stored rows of some folders, each listed by itself."""
        table, path = TABLES[name], self.path(name)
        folders = [f for f in (f"{path}/{table.partitions[0]}={v}" for v in values) if files.exists(self.spark, f)]
        if not folders:
            return self.spark.createDataFrame([], table.ddl)
        return self._listed(name, self.spark.read.schema(table.ddl).option("basePath", path).parquet(*folders))

    def _switches(self, name: str) -> dict[str, list[str]]:
        """Of each merged label that counts: the folders it stands for.  One small file for each merged slot."""
        root = f"{self.path(name)}_merged"
        return {label: files.read_text(self.spark, f"{root}/{label}").split("\n")
                for label in files.children(self.spark, root) if label.startswith(_MERGED) and not label.endswith(".tmp")}

    def _listed(self, name: str, rows: DataFrame) -> DataFrame:
        """Without the folders that a merged one stands for, and without merged ones that are not switched to yet."""
        table = TABLES[name]
        if not table.in_batches:
            return rows
        switches = self._switches(name)
        rows = rows.where(~F.col("batch").startswith(_MERGED) | F.col("batch").isin(list(switches)))
        gone = sorted({folder for folders in switches.values() for folder in folders})
        return rows.where(~F.concat_ws("/", *table.partitions).isin(gone)) if gone else rows

    def compact(self, name: str, values: Iterable[int]) -> int:
        """Merge the batch folders of closed slots (values of the first partition column) into one each.

        Readers follow a list: a merged folder counts from the moment its switch, one small file, is there,
        and the folders that it names do not count from then on.  So a lookup sees the same rows before,
        during and after.  The replaced folders are dropped by the next call, which leaves
        lookups under way their files.  A run that broke off leaves a folder without a switch, which
        nobody reads and the next run drops.  Returns how many slots were merged.
        """
        table, path = TABLES[name], self.path(name)
        if not table.in_batches:
            raise ValueError(f"{name} is not written in batches")
        first, switches = table.partitions[0], self._switches(name)
        for folders in switches.values():
            for folder in folders:
                value, label = folder.split("/")
                files.delete(self.spark, f"{path}/{first}={value}/batch={label}")
        todo: dict[int, list[str]] = {}
        for value in sorted(set(values)):
            labels = [c.removeprefix("batch=") for c in files.children(self.spark, f"{path}/{first}={value}") if c.startswith("batch=")]
            for stale in (label for label in labels if label.startswith(_MERGED) and label not in switches):
                files.delete(self.spark, f"{path}/{first}={value}/batch={stale}")
            labels = [label for label in labels if not label.startswith(_MERGED) or label in switches]
            if len(labels) > 1:
                todo[value] = labels
        if not todo:
            return 0
        run = uuid.uuid4().hex
        label = F.concat(F.lit(f"{_MERGED}{run}-"), F.col(first).cast("string"))
        self._write(name, self._in_folders(name, todo).withColumn("batch", label))
        for value, labels in todo.items():
            files.write_text(self.spark, f"{path}_merged/{_MERGED}{run}-{value}", "\n".join(f"{value}/{old}" for old in labels))
        return len(todo)

    def _stamped(self, name: str, rows: DataFrame, written_at: datetime | None) -> DataFrame:
        table = TABLES[name]
        stored = list(table.columns)
        if table.ttl is not None:
            now = F.current_timestamp() if written_at is None else _timestamp(written_at)
            rows = rows.withColumn("written_at", F.unix_micros(now))
            stored.append("written_at")
        return rows.select(*stored, *[p for p in table.partitions if p not in stored])

    def _write(self, name: str, rows: DataFrame, n_rows: int | None = None) -> None:
        """Rebalancing by slot gives each slot few files; an oversized slot is split
        over several tasks at run time.  Streams have no such re-planning: they give the number of
        rows, and ranges of slot and place are dealt to as many tasks as files are due.  Rows are sorted by place
        inside the files, so a lookup skips row groups of other places, and by a Bloom filter those without its topic.
        """
        table = TABLES[name]
        if n_rows is None:
            rows = rows.hint("rebalance", *[F.col(p) for p in table.partitions])
        elif n_rows <= _FILE_ROWS:
            rows = rows.repartition(1)
        else:
            rows = rows.repartitionByRange(-(-n_rows // _FILE_ROWS), *table.partitions, *table.sort)
        writer = (rows.sortWithinPartitions(*table.partitions, *table.sort)
                  .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*table.partitions))
        for column in table.lookup:
            writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(self.path(name))

    def drop_slots(self, name: str, slots: Iterable[int]) -> None:
        for slot in slots:
            files.delete(self.spark, f"{self.path(name)}/{TABLES[name].folder(slot)}")

    def newest_writes(self, name: str) -> DataFrame:
        """The partition columns and `newest`, the latest `written_at` of each folder.

        Spark takes it from the Parquet footers: the aggregate is pushed down, and no row group
        is read.  The settings that need be belong to a session of their own.
        """
        table, path = TABLES[name], self.path(name)
        if not files.exists(self.spark, path):
            return self.spark.createDataFrame([], table.ddl).select(*table.partitions, F.col("written_at").alias("newest"))
        footers = self.spark.newSession()
        footers.conf.set("spark.sql.sources.useV1SourceList", "")
        footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        rows = footers.read.schema(table.ddl).parquet(path)
        return rows.groupBy(*table.partitions).agg(F.max("written_at").alias("newest"))

    def _limit(self, name: str, as_of: datetime | None) -> Column:
        """Rows written up to here are past their retention."""
        now = F.current_timestamp() if as_of is None else _timestamp(as_of)
        return F.unix_micros(now - F.expr(f"interval {TABLES[name].ttl} seconds"))

    def expire(self, name: str, as_of: datetime | None = None) -> list[str]:
        """Drop the partition folders in which every row is past its retention.

        Returns the folders.  The list comes to the driver: one entry per folder.
        """
        table = TABLES[name]
        if table.ttl is None:
            return []
        found = self.newest_writes(name)
        limit = found.sparkSession.range(1).select(self._limit(name, as_of)).first()[0]
        expired = found.where(F.col("newest") <= limit).collect()
        folders = sorted("/".join(f"{p}={row[p]}" for p in table.partitions) for row in expired)
        for folder in folders:
            files.delete(self.spark, f"{self.path(name)}/{folder}")
            files.delete(self.spark, f"{self.path(name)}_merged/{folder.rsplit('=', 1)[1]}")
        return folders

    def visible_slots(self, name: str, as_of: datetime | None = None) -> list[int]:
        """The slots that have a visible row, from folder names and footers; for tables with a folder per slot."""
        table = TABLES[name]
        if table.partitions != (table.slot,):
            raise ValueError(f"{name} has no folder per slot")
        if table.ttl is None:
            return self.slots(name)
        found = self.newest_writes(name)
        limit = found.sparkSession.range(1).select(self._limit(name, as_of)).first()[0]
        return sorted(r[0] for r in found.where(F.col("newest") > limit).select(table.slot).collect())
