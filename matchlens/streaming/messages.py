"""Reading, showing and writing keyed messages.

A stream's position lives in its checkpoint: the same checkpoint resumes, a new
one starts over from ``startingOffsets``. The topic reader needs Spark's Kafka
package; every other function takes any frame with topic, key and value.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from matchlens.operators.state import last_changes
from matchlens.session import work_folder
from matchlens.sources.committed import PARTS, Batch, Committed

# Line shown per message, with the key padded to 12.
LINE = "[%s] %-12s -> %s"


def kafka_options(
    servers: str, topic: str, reset: bool = False, extra: dict[str, str] | None = None
) -> dict[str, str]:
    """Reader options; a reader starts at the earliest message unless told otherwise.

    With ``reset`` they start at the beginning even where ``extra`` says otherwise.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    options.update(extra or {})
    if reset:
        options["startingOffsets"] = "earliest"
    return options


def read_messages(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def decode_messages(messages: DataFrame, *more: str) -> DataFrame:
    """Topic, key and value as text, further columns, and the line that shows them."""
    decoded = messages.select(
        "topic", F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *more
    )
    return decoded.withColumn("line", F.format_string(LINE, "topic", "key", "value"))


def land_messages(
    messages: DataFrame, path: str, checkpoint: str, once: bool = False, form: str = "parquet"
) -> StreamingQuery:
    """Append a stream to files; ``once`` stops after the messages there are now."""
    writer = (
        messages.writeStream.format(form)
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer).start()


def print_messages(messages: DataFrame, checkpoint: str) -> StreamingQuery:
    lines = decode_messages(messages).select("line")
    return (
        lines.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .start()
    )


def write_messages(
    df: DataFrame, servers: str, topic: str, key: str = "key", value: str = "value"
) -> None:
    """Send rows to a topic as keyed messages."""
    keyed = df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    keyed.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


class KeyedState:
    """A keyed table kept up to date from a stream, with its checkpoint beside it.

    A micro-batch replaces the parts of the table that its keys are in and records its number, both under one
    marker. A batch that comes again after a failure finds its number recorded and changes nothing; one that
    failed before its marker leaves nothing that is read. The stream resumes from its checkpoint. A reset
    begins a new run, with a checkpoint and numbers of its own, so that all messages are read again; as a key's last change
    counts, reading them again gives the same table.
    """

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, key: str, order: list[str], parts: int = PARTS) -> None:
        self.spark, self.root, self.schema, self.key, self.order, self.parts = spark, root, schema, key, order, parts

    def run_number(self) -> int:
        """Number of the present run: that of resets so far."""
        return Committed(self.spark, self.root).parts("#resets").get(0, 0)

    def reset(self) -> None:
        """Read all messages again with the next start."""
        batch = Batch(self.spark, self.root)
        batch.record("resets", self.run_number() + 1)
        batch.commit()

    def rows(self) -> DataFrame:
        return Committed(self.spark, self.root).read("state", self.schema).drop("part", "version")

    def _changed(self, table: DataFrame, changes: DataFrame) -> DataFrame:
        """Rows after changes; a change older than the row that is there is late and has no effect."""
        return last_changes(table.unionByName(changes), self.key, self.order).select(table.columns)

    def apply(self, changes: DataFrame, number: int) -> bool:
        """Apply one micro-batch; False if it had been applied before."""
        batch = Batch(self.spark, self.root)
        name = f"run-{self.run_number()}"
        if number <= batch.done(name):
            return False
        folder = f"{work_folder(self.spark)}/changes-{uuid4().hex}"
        last_changes(changes.select(self.schema.names), self.key, self.order).select(self.schema.names).write.parquet(folder)
        stored = self.spark.read.schema(self.schema).parquet(folder)
        batch.change("state", self.schema, stored, self.key, self._changed, self.parts)
        batch.record(name, number)
        batch.commit()
        return True

    def start(self, messages: DataFrame, prepare: Callable[[DataFrame], DataFrame], once: bool = False) -> StreamingQuery:
        """Keep the table up to date from a stream; ``prepare`` turns messages into changes."""
        writer = (
            prepare(messages)
            .writeStream.option("checkpointLocation", f"{self.root}/checkpoints/run-{self.run_number()}")
            .foreachBatch(lambda changes, number: self.apply(changes, number) and None)
        )
        return (writer.trigger(availableNow=True) if once else writer).start()


def write_keyed_files(messages: DataFrame, path: str, parts: int, order: list[str], mode: str = "errorifexists") -> None:
    """Send keyed messages to files instead of a topic: one file a part, all messages of a key in one file, in order.

    A key's messages stay in the order of ``order``, as in a topic's partition. Null keys go to one part.
    """
    numbered = messages.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    sorted_by_key = numbered.repartition(parts, "partition").sortWithinPartitions("partition", *order)
    sorted_by_key.write.mode(mode).partitionBy("partition").parquet(path)


def send_to_keyed_files(messages: DataFrame, path: str, checkpoint: str, parts: int, order: list[str], once: bool = False) -> StreamingQuery:
    """As :func:`write_keyed_files` for a stream: a folder for each micro-batch, which replaces it if it is sent again."""
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, number: write_keyed_files(batch, f"{path}/batch={number}", parts, order, "overwrite")
    )
    return (writer.trigger(availableNow=True) if once else writer).start()
