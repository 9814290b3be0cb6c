"""Tables in versioned folders behind one committed marker.

A batch writes each table's changed parts to folders of its own version, and then the marker: one
file that lists for every part of every table the version that holds it, and the batches done. Readers
follow the newest marker, so they see all of a batch or nothing of it. What a failed batch has
written is listed by no marker; the batch run again takes the same version and replaces it.

A keyed table is dealt by a hash of its key into a fixed number of parts. A change reads and
replaces the parts that its keys are in; the files of the others stay as they are and are listed on. The marker has
a row for each part, so what the driver reads is bounded by the tables' parts and the batches of landed rows.

One writer at a time. Folders may be in any store that Spark writes to.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARKER = "name string, part int, held long"
PART = "part"
# Parts of a keyed table unless given; a part's rows should fit a few tasks.
PARTS = 64


def part_of(key: str, parts: int) -> Column:
    """Part of a key: the first 28 bits of its MD5, so that other engines find the same part."""
    bits = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 7), 16, 10).cast("long")
    return F.coalesce(F.pmod(bits, F.lit(parts)), F.lit(0)).cast("int").alias(PART)


class Committed:
    """The tables below a root, as of the newest marker when the object is made."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.version, self.held = 0, {}
        try:
            markers = spark.read.schema(f"{MARKER}, version long").parquet(f"{self.root}/commits")
            newest = markers.agg(F.max("version")).first()[0]
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            newest = None
        if newest is not None:
            self.version = newest
            rows = markers.where(F.col("version") == newest).collect()
            self.held = {(r["name"], r["part"]): r["held"] for r in rows}

    def _folder(self, name: str, version: int) -> str:
        return f"{self.root}/data/{name}/version={version}"

    def parts(self, name: str) -> dict[int, int]:
        """Version that holds each part of a table."""
        return {part: held for (table, part), held in self.held.items() if table == name}

    def read(self, name: str, schema: T.StructType, only: list[int] | None = None) -> DataFrame:
        """Rows of a table, or of some of its parts, with ``part`` and ``version``."""
        full = T.StructType([*schema.fields, T.StructField("version", T.LongType()), T.StructField(PART, T.IntegerType())])
        held = self.parts(name)
        wanted = held.keys() if only is None else held.keys() & set(only)
        folders = [f"{self._folder(name, held[p])}/{PART}={p}" for p in sorted(wanted)]
        if not folders:
            return self.spark.createDataFrame([], full)
        reader = self.spark.read.schema(full).option("basePath", f"{self.root}/data/{name}")
        return reader.parquet(*folders)


class Batch:
    """Changes that become visible together by :meth:`commit`; a batch writes each table once."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.base = Committed(spark, root)
        self.spark, self.version = spark, self.base.version + 1
        self.held = dict(self.base.held)

    def _write(self, name: str, dealt: DataFrame) -> list[int]:
        """Write rows that have their ``part``; the parts that there are now."""
        folder = self.base._folder(name, self.version)
        dealt.write.mode("overwrite").partitionBy(PART).parquet(folder)
        try:
            written = self.spark.read.schema(f"{PART} int").option("basePath", folder).parquet(f"{folder}/{PART}=*")
        except AnalysisException as error:  # no row, no part
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return []
        return [r[PART] for r in written.select(PART).distinct().collect()]

    def replace(self, name: str, rows: DataFrame, key: str, parts: int = PARTS) -> None:
        """All rows of a keyed table."""
        dealt = rows.withColumn(PART, part_of(key, parts))
        found = self._write(name, dealt.repartition(parts, PART))
        self.held = {k: v for k, v in self.held.items() if k[0] != name}
        self.held.update({(name, part): self.version for part in found})

    def change(
        self, name: str, schema: T.StructType, changes: DataFrame, key: str, apply: Callable[[DataFrame, DataFrame], DataFrame], parts: int = PARTS
    ) -> list[int]:
        """Replace the parts that ``changes`` touch by ``apply(rows of these parts, changes)``; returns them.

        ``changes`` are read twice, so they should be stored.
        """
        touched = sorted(r[PART] for r in changes.select(part_of(key, parts)).distinct().collect())
        if not touched:
            return []
        before = self.base.read(name, schema, touched).drop(PART, "version")
        dealt = apply(before, changes).withColumn(PART, part_of(key, parts))
        found = self._write(name, dealt.repartition(len(touched), PART))
        for part in touched:
            self.held.pop((name, part), None)
        self.held.update({(name, part): self.version for part in found})
        return touched

    def land(self, name: str, rows: DataFrame, number: int) -> DataFrame:
        """Add rows as one part of a landed table, numbered by its batch; returns them as stored.

        Landing a number again replaces its rows.
        """
        found = self._write(name, rows.withColumn(PART, F.lit(number)))
        self.held.pop((name, number), None)
        if found:
            self.held[name, number] = self.version
        schema = T.StructType([*rows.schema.fields])
        folder = f"{self.base._folder(name, self.version)}/{PART}={number}"
        return self.spark.read.schema(schema).parquet(folder) if found else self.spark.createDataFrame([], schema)

    def done(self, name: str) -> int:
        """Last batch recorded under a name, -1 before the first."""
        return self.base.parts(f"#{name}").get(0, -1)

    def record(self, name: str, number: int) -> None:
        """Remember a batch as done under a name."""
        self.held[f"#{name}", 0] = number

    def commit(self) -> int:
        """Write the marker as one file; from here on readers see the batch."""
        rows = [(name, part, held) for (name, part), held in sorted(self.held.items())] or [("", 0, 0)]
        marker = self.spark.createDataFrame(rows, MARKER).coalesce(1)
        marker.write.mode("overwrite").parquet(f"{self.base.root}/commits/version={self.version}")
        return self.version
