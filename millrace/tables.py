"""Layer tables (SNK-1, SNK-2): partitioned Parquet below one root, or Iceberg in a catalog.

On Parquet a full replacement is written beside the live copy. It becomes visible when a small
numbered file naming it is renamed into place; the greatest number is the live copy, so a reader
sees the old copy or the new one, and a job may read the table it replaces. The copy before the
live one stays for readers that have begun, older ones are removed.

A partitioned table (but a log) keeps copies of single partitions, ``day=…/copy=…``, and its numbered
file lists the live ones. Overwriting some partitions or appending to them writes new copies and then
a new list, so these too are seen whole or not at all, a job that dies leaves nothing visible, and
partitions that a write does not touch keep their files.

Log tables are read as streams from their folder; there a batch is a partition of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import LongType, StructType

from millrace.schemas import TABLES

MARKER = "_live-"  # followed by a growing number and the name of a finished copy
COPY = "copy"  # the last folder level of a partitioned table


@dataclass(frozen=True)
class Store:
    """Where the tables live; ``catalog`` switches from Parquet folders to Iceberg tables."""

    spark: SparkSession
    root: str = ""
    catalog: str | None = None

    def _folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name.replace('.', '/')}"

    def _file_system(self, folder: str):
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

    def _copies(self, name: str) -> list[tuple[str, str]]:
        """(marker, folder) of the finished copies, the live one last."""
        fs, folder = self._file_system(self._folder(name))
        if not fs.exists(folder):
            return []
        found = sorted(status.getPath().getName() for status in fs.listStatus(folder))
        markers = [n for n in found if n.startswith(MARKER)]
        return [(n, n.removeprefix(MARKER).partition("-")[2]) for n in markers]

    def _live(self, name: str) -> str | None:
        """Folder of the visible copy, None for a table that was never written."""
        copies = self._copies(name)
        return f"{self._folder(name)}/{copies[-1][1]}" if copies else None

    def _listed(self, name: str, marker: str) -> list[str]:
        """What a marker lists: the live copies of a table's partitions, none for whole copies."""
        fs, path = self._file_system(f"{self._folder(name)}/{marker}")
        stream = fs.open(path)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            return [line for line in text.split("\n") if line]
        finally:
            stream.close()

    def partitions(self, name: str) -> list[str]:
        """The live partition copies of a partitioned table, as folders below the table's."""
        copies = self._copies(name)
        return self._listed(name, copies[-1][0]) if copies else []

    def _publish(self, name: str, version: str, listed: Sequence[str] = ()) -> None:
        """Make a finished copy, or a list of partition copies, the live one, and remove what only markers
        before the last one name."""
        fs, _ = self._file_system(self._folder(name))
        copies = self._copies(name)
        number = int(copies[-1][0].removeprefix(MARKER).partition("-")[0]) + 1 if copies else 0
        fresh = self._file_system(f"{self._folder(name)}/_new-{version}")[1]
        stream = fs.create(fresh, True)
        stream.write("\n".join(listed).encode())
        stream.close()
        marker = self._file_system(f"{self._folder(name)}/{MARKER}{number:012d}-{version}")[1]
        if fs.exists(marker) or not fs.rename(fresh, marker):
            raise OSError(f"cannot publish {marker}")
        used = {*listed, *(self._listed(name, copies[-1][0]) if copies else ())}
        for old_marker, old in copies[:-1]:
            for gone in (*(c for c in self._listed(name, old_marker) if c not in used), old_marker, old):
                fs.delete(self._file_system(f"{self._folder(name)}/{gone}")[1], True)

    def exists(self, name: str) -> bool:
        if self.catalog:
            return self.spark.catalog.tableExists(f"{self.catalog}.{name}")
        return self._live(name) is not None

    def ensure(self, layer: str) -> list[str]:
        """SNK-2: create the declared tables of a layer that are absent; returns all their names."""
        names = [name for name in TABLES if name.split(".")[0] == layer]
        if self.catalog:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.catalog}.{layer}")
        for name in names:
            table = TABLES[name]
            if self.catalog:
                self.spark.sql(iceberg_ddl(f"{self.catalog}.{name}", name))
            elif not self.exists(name):
                empty = self.spark.createDataFrame([], table.schema)
                self.write(empty, name, mode="replace", batch_id=-1)
        return names

    def read(self, name: str, since: str | None = None) -> DataFrame:
        """A table with its declared schema; log tables also carry ``batch_id``.

        ``since`` (yyyy-MM-dd) keeps the rows from that day on and reads only their partitions;
        it is for tables partitioned by day.
        """
        if self.catalog:
            df = self.spark.read.table(f"{self.catalog}.{name}")
        else:
            live = self._live(name)
            if live is None:
                raise FileNotFoundError(f"table {name} does not exist below {self.root}")
            df = self.read_partitions(name, self.partitions(name)) if _by_copies(name) else self.spark.read.schema(_stored(name)).parquet(live)
        if since is None:
            return df
        day, expression = _day_partition(name)
        start = F.lit(since).cast("date")
        # A catalog derives its hidden day partition from a filter on the time itself.
        return df.filter((F.expr(expression) if self.catalog else F.col(day)) >= start)

    def read_partitions(self, name: str, listed: Sequence[str]) -> DataFrame:
        """The rows of some partition copies."""
        folder = self._folder(name)
        if not listed:
            return self.spark.createDataFrame([], _stored(name))
        stored = _stored(name).add(COPY, "string")
        reader = self.spark.read.schema(stored).option("basePath", folder)
        return reader.parquet(*[f"{folder}/{copy}" for copy in listed]).drop(COPY)

    def read_stream(self, name: str, max_files: int | None = None) -> DataFrame:
        """New rows of a log table as a stream; ``max_files`` bounds what one batch takes of a backlog."""
        if self.catalog:
            return self.spark.readStream.table(f"{self.catalog}.{name}")
        live = self._live(name)
        if live is None:
            raise FileNotFoundError(f"table {name} does not exist below {self.root}")
        reader = self.spark.readStream.schema(_stored(name))
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(live)

    def write(
        self,
        df: DataFrame,
        name: str,
        mode: str = "append",
        batch_id: int | None = None,
        run: str | None = None,
    ) -> int:
        """SNK-1, A-11: write and return the number of rows, counted on the way.

        ``append`` adds rows; ``overwrite`` replaces the partitions present in ``df`` (the whole
        table when it has none); ``replace`` swaps in a new copy of the whole table. Log tables
        take a ``batch_id``, as argument or column: writing the same batch again replaces it, so
        a replayed micro-batch adds nothing. An append to a partitioned table may name its ``run``
        (letters and digits): appending under the same name again replaces what that run added.
        """
        if mode not in ("append", "overwrite", "replace"):
            raise ValueError(f"unknown write mode {mode!r}")
        table = TABLES[name]
        columns = [F.col(f"`{c.name}`").cast(c.dataType).alias(c.name) for c in table.schema]
        partitions = list(table.partition_by)
        if table.log:
            number = F.col("batch_id") if batch_id is None else F.lit(batch_id)
            columns.append(number.cast("bigint").alias("batch_id"))
            partitions.append("batch_id")
            mode = "overwrite" if mode == "append" else mode
        rows = df.select(*columns)
        if not self.catalog:
            rows = rows.withColumns({c: F.expr(e) for c, e in table.derived.items()})
            if table.partition_by:
                # One shuffle keeps files few; it splits large partitions and joins small ones.
                rows = rows.hint("rebalance", *table.partition_by)
        written = Observation()
        rows = rows.observe(written, F.count(F.lit(1)).alias("rows"))
        if self.catalog:
            self._write_catalog(rows, name, mode)
        else:
            self._write_folder(rows, name, mode, partitions, run)
        return written.get["rows"]

    def _write_catalog(self, rows: DataFrame, name: str, mode: str) -> None:
        target = rows.writeTo(f"{self.catalog}.{name}")
        if mode == "append":
            target.append()
        elif mode == "overwrite":
            target.overwritePartitions()
        else:
            target.overwrite(F.lit(True))

    def _write_folder(
        self, rows: DataFrame, name: str, mode: str, partitions: list[str], run: str | None
    ) -> None:
        live = self._live(name)
        if _by_copies(name):
            self._write_copies(rows, name, mode, partitions, run)
        elif mode == "replace" or live is None or (mode == "overwrite" and not partitions):
            version = f"v-{uuid.uuid4().hex}"
            rows.write.partitionBy(*partitions).parquet(f"{self._folder(name)}/{version}")
            self._publish(name, version)
        elif mode == "overwrite":
            rows.write.partitionBy(*partitions).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(live)
        else:
            rows.write.partitionBy(*partitions).mode("append").parquet(live)

    def _write_copies(
        self, rows: DataFrame, name: str, mode: str, partitions: list[str], run: str | None
    ) -> None:
        """New copies of the partitions in ``rows``, then a list with them and the live ones that stay."""
        prefix = f"{run}." if run else ""
        copy = f"{COPY}={prefix}{uuid.uuid4().hex}"
        folder = self._folder(name)
        rows = rows.withColumn(COPY, F.lit(copy.removeprefix(f"{COPY}=")))
        rows.write.mode("append").partitionBy(*partitions, COPY).parquet(folder)
        fs, found = self._file_system("/".join([folder, *["*"] * len(partitions), copy]))
        depth = len(partitions) + 1
        paths = [status.getPath().toString().split("/") for status in fs.globStatus(found) or []]
        fresh = ["/".join(path[-depth:]) for path in paths]
        replaced = {path.rpartition("/")[0] for path in fresh}
        stay = [] if mode == "replace" else self.partitions(name)
        if mode == "overwrite":
            stay = [path for path in stay if path.rpartition("/")[0] not in replaced]
        elif run:
            stay = [path for path in stay if not path.rpartition("/")[2].startswith(f"{COPY}={prefix}")]
        self._publish(name, f"v-{uuid.uuid4().hex}", [*stay, *fresh])


def _by_copies(name: str) -> bool:
    return bool(TABLES[name].partition_by) and not TABLES[name].log


def _day_partition(name: str) -> tuple[str, str]:
    """(partition column, time column) of a table partitioned by day."""
    for column, expression in TABLES[name].derived.items():
        if expression.startswith("to_date"):
            return column, expression.removeprefix("to_date(").rstrip(")")
    raise ValueError(f"table {name} is not partitioned by day")


def _stored(name: str) -> StructType:
    schema = StructType(list(TABLES[name].stored_schema))
    return schema.add("batch_id", LongType()) if TABLES[name].log else schema


def iceberg_ddl(full_name: str, name: str) -> str:
    """CREATE TABLE text; a derived day or month becomes a hidden partition transform."""
    table = TABLES[name]
    parts = []
    for column in table.partition_by:
        expression = table.derived.get(column, column)
        source = expression[expression.find("(") + 1 :].split(",")[0].rstrip(")")
        if expression.startswith("to_date"):
            parts.append(f"days({source})")
        elif expression.startswith("date_format"):
            parts.append(f"months({source})")
        elif "(" not in expression:  # a catalog's own buckets hash otherwise; such tables are replaced whole
            parts.append(expression)
    ddl = table.ddl
    if table.log:
        ddl += ", batch_id BIGINT"
        parts.append("batch_id")
    partitioned = f" PARTITIONED BY ({', '.join(parts)})" if parts else ""
    return f"CREATE TABLE IF NOT EXISTS {full_name} ({ddl}) USING iceberg{partitioned}"
