"""Parquet tables in a shared folder.

A replaced table gets a folder per version, which counts once Spark has marked
its write as successful; an appended table gets a folder per batch. A replayed
batch overwrites its own folders, so a run that died half-way is simply run
again.

A partitioned table is replaced part by part: a version holds the parts it rewrites, and a
small table beside it says which version each part is in. Other parts keep their files.
Parts are months, years or hash buckets, so there are few of them whatever the data.

Old batches of an appended table can be folded into one set of files each time.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.schemas import PARTITIONED, TABLES
from airstrata.session import delete_path, glob_paths, path_exists


def read_if_exists(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    if not path_exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


@dataclass(frozen=True)
class Store:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def _version_path(self, name: str, version: int) -> str:
        return f"{self.path(name)}/v={version}"

    def replace(
        self, name: str, df: DataFrame, version: int, sort_by: Sequence[str] = ()
    ) -> DataFrame:
        """Write ``df`` as a version of the table and make it the current one.

        ``sort_by`` orders the rows over and within the files, so that readers
        can skip files; its columns together should be (nearly) unique.
        """
        target = self._version_path(name, version)
        if sort_by:
            df = df.repartitionByRange(*sort_by).sortWithinPartitions(*sort_by)
        df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def patch(
        self,
        name: str,
        df: DataFrame,
        version: int,
        part: str,
        touched: Collection[int] | None = None,
        sort_by: Sequence[str] = (),
    ) -> DataFrame:
        """Write the ``touched`` parts of a partitioned table as a version; returns them.

        ``part`` is the SQL expression of the number of a row's part.
        ``df`` holds all rows of these parts; a part without rows is gone. None touches all
        parts, also those that ``df`` has no rows for.
        """
        target = self._version_path(name, version)
        before = self.parts(name, before=version)
        # adaptive execution splits a large part over tasks and puts small ones together
        spread = df.withColumn("part", F.expr(part).cast("int")).hint("rebalance", "part")
        spread = spread.sortWithinPartitions("part", *sort_by)
        spread.write.mode("overwrite").partitionBy("part").parquet(target)
        written = [int(p.split("/part=")[-1]) for p in glob_paths(self.spark, f"{target}/part=*")]
        kept = {} if touched is None else {p: v for p, v in before.items() if p not in touched}
        rows = [*kept.items(), *((p, version) for p in written)]
        # the new parts count from here on
        listed = self.spark.createDataFrame(rows, "part int, version int").coalesce(1)
        self.replace(f"{name}.parts", listed, version)
        return self._read_parts(name, dict.fromkeys(written, version), df.schema)

    def parts(self, name: str, before: int | None = None) -> dict[int, int]:
        """The version that each part of a partitioned table is in."""
        table = self.current(f"{name}.parts", before)
        return {} if table is None else {r["part"]: r["version"] for r in table.collect()}

    def _read_parts(self, name: str, parts: dict[int, int], schema) -> DataFrame:
        paths = [f"{self._version_path(name, v)}/part={p}" for p, v in sorted(parts.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read_parts(
        self, name: str, only: Collection[int] | None = None, before: int | None = None
    ) -> DataFrame | None:
        """The given parts, or all, of a partitioned table; None if there are none."""
        parts = {p: v for p, v in self.parts(name, before).items() if only is None or p in only}
        schema = TABLES.get(name)
        if schema is None and parts:
            part, version = next(iter(parts.items()))
            schema = self.spark.read.parquet(f"{self._version_path(name, version)}/part={part}").schema
        return self._read_parts(name, parts, schema) if parts else None

    def versions(self, name: str) -> list[int]:
        """Versions whose write was completed, oldest first."""
        if name in PARTITIONED:
            name = f"{name}.parts"
        done = glob_paths(self.spark, f"{self.path(name)}/v=*/_SUCCESS")
        return sorted(int(path.split("/v=")[-1].split("/")[0]) for path in done)

    def current_version(self, name: str, before: int | None = None) -> int | None:
        found = [v for v in self.versions(name) if before is None or v < before]
        return found[-1] if found else None

    def current(self, name: str, before: int | None = None) -> DataFrame | None:
        """The latest complete version, or the latest one before ``before``."""
        version = self.current_version(name, before)
        if version is None:
            return None
        if name in PARTITIONED:
            table = self.read_parts(name, before=before)
            if table is None and name in TABLES:
                table = self.spark.createDataFrame([], TABLES[name])
            return table
        return read_if_exists(self.spark, self._version_path(name, version), TABLES.get(name))

    def expire(self, name: str, before: int) -> None:
        """Delete the versions of a replaced table older than ``before``.

        Of a partitioned table those parts stay that a remaining version still reads.
        """
        if name in PARTITIONED:
            current = self.versions(name)
            live = {
                f"/v={v}/part={p}"
                for version in current
                if version >= before
                for p, v in self.parts(name, before=version + 1).items()
            }
            for path in glob_paths(self.spark, f"{self.path(name)}/v=*/part=*"):
                place = path[path.rindex("/v=") :]
                if int(place.split("/")[1][2:]) < before and place not in live:
                    delete_path(self.spark, path)
            name = f"{name}.parts"
        for version in self.versions(name):
            if version < before:
                delete_path(self.spark, self._version_path(name, version))

    def append(
        self, name: str, df: DataFrame, batch_id: int, load: str | None = None
    ) -> DataFrame:
        """Write a batch of an append-only table; the same batch again replaces it.

        A table whose batches are made of several loads names each.
        """
        target = f"{self.path(name)}/batch_id={batch_id}" + (f"/load={load}" if load else "")
        df.write.mode("overwrite").parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def appended(self, name: str, upto: int | None = None) -> DataFrame | None:
        """All batches of an append-only table, or those up to ``upto``."""
        table = self._batches(name, upto)
        return None if table is None else table.drop("batch_id", "load")

    def _batches(self, name: str, upto: int | None = None) -> DataFrame | None:
        """Folded batches, and the folders of those behind the last fold, with batch_id."""
        schema = TABLES.get(name)
        if schema is not None:
            schema += ", batch_id int"
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        folds, table = self.folds(name), None
        # a fold begins behind the one before it
        wanted = [v for v, last in zip(folds, [None, *folds]) if None in (upto, last) or last < upto]
        if wanted:
            table = reader.parquet(*[self._version_path(f"{name}.folded", v) for v in wanted])
        if not folds:
            table = read_if_exists(self.spark, self.path(name), schema)
        elif (upto is None or upto > folds[-1]) and glob_paths(self.spark, f"{self.path(name)}/batch_id=*"):
            behind = reader.parquet(self.path(name)).filter(F.col("batch_id") > folds[-1])
            table = table.unionByName(behind)
        if table is None or upto is None:
            return table
        return table.filter(F.col("batch_id") <= upto)

    def batch(self, name: str, batch_id: int, schema: str) -> DataFrame:
        """One batch of an append-only table, empty if it was never written."""
        fold = next((v for v in self.folds(name) if v >= batch_id), None)
        if fold is not None:
            rows = self.spark.read.schema(f"{schema}, batch_id int").parquet(self._version_path(f"{name}.folded", fold))
            return rows.filter(F.col("batch_id") == batch_id).drop("batch_id")
        table = read_if_exists(self.spark, f"{self.path(name)}/batch_id={batch_id}", schema)
        return self.spark.createDataFrame([], schema) if table is None else table.drop("load")

    def folds(self, name: str) -> list[int]:
        """The last batch of each completed fold of an append-only table, ascending."""
        return self.versions(f"{name}.folded")

    def fold(self, name: str, upto: int, sort_by: Sequence[str] = ()) -> DataFrame | None:
        """Put the batches up to ``upto`` that no fold holds yet into one set of files.

        Every row is rewritten once, however often the table is folded, and keeps its batch
        number. Readers go over to the new files with Spark's mark of a successful write and
        pass over the folders from then on, so a batch replayed later, which writes its own
        folder again, does not count twice. A fold that died is run again. ``sort_by`` is that
        of ``replace``. The folders stay for readers under way, until ``expire_folded``.
        """
        folds = self.folds(name)
        if folds and folds[-1] >= upto:
            return None
        if glob_paths(self.spark, f"{self.path(name)}/batch_id=*/load=*"):
            raise ValueError(f"the batches of {name} are made of several loads, which are not folded")
        rows = self._batches(name, upto)
        if rows is None:
            return None
        if folds:
            rows = rows.filter(F.col("batch_id") > folds[-1])
        # without an order, adaptive execution joins small files and splits large ones
        return self.replace(f"{name}.folded", rows if sort_by else rows.hint("rebalance"), upto, sort_by)

    def expire_folded(self, name: str) -> None:
        """Delete the folders of folded batches."""
        folds = self.folds(name)
        for path in glob_paths(self.spark, f"{self.path(name)}/batch_id=*") if folds else []:
            if int(path.split("/batch_id=")[-1]) <= folds[-1]:
                delete_path(self.spark, path)
