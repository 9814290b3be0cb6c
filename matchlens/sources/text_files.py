"""Lines with their numbers, and JSON values run together, out of large text files.

A file is read by many tasks, a split each. Lines are written once with their place in their split; a
line's number is that place and the lines of the splits before it. What depends on all text before a line is
carried the same way: sums of a stretch of lines, then of the stretches before, then of the lines
before in the stretch. No task sees more than a stretch, or one row for each stretch of a file.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from matchlens.session import work_folder

LINE = "file string, split long, id long, value string"
# Lines of a stretch.
STRETCH = 1024
# Bytes that a task reads at least, in as many splits as that takes, unless the text is too short to keep all tasks busy.
TASK_BYTES = 8 << 20

# Parts of JSON text outside white space: a string, a bracket, or anything else up to those. A string holds no line break.
TOKEN = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"?|[{}\[\]]|[^"{}\[\]\s]+'


def numbered_lines(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """``file``, ``line`` (from 0) and ``value`` for every line of text files.

    Lines end at line feeds; text after the last one is a line too. ``split_bytes`` sets the size of splits for this read.
    """
    folder = f"{work_folder(spark)}/lines-{uuid4().hex}"
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        if split_bytes:
            spark.conf.set(setting, str(split_bytes))
        read = spark.read.option("lineSep", "\n").text(path)
        if split_bytes and split_bytes < TASK_BYTES:
            # Small splits would be a task and a file each.
            splits = read.rdd.getNumPartitions()
            read = read.coalesce(max(spark.sparkContext.defaultParallelism, -(-splits * split_bytes // TASK_BYTES)))
        place = F.monotonically_increasing_id().alias("id")
        read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), place, "value").write.parquet(folder)
    finally:
        spark.conf.set(setting, before)
    stored = spark.read.schema(LINE).parquet(folder)
    splits = stored.groupBy("file", "split").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "split", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    line = (F.col("before") + F.col("id") - F.col("first")).alias("line")
    return stored.join(offsets, ["file", "split"]).select("file", line, "value")


def with_total_before(lines: DataFrame, amount: str, name: str) -> DataFrame:
    """Lines with the sum of a column over all lines of the file before them."""
    staged = lines.withColumn("stretch", F.expr(f"line div {STRETCH}"))
    sums = staged.groupBy("file", "stretch").agg(F.sum(amount).alias("sum"))
    earlier = Window.partitionBy("file").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", "stretch", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "stretch").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return staged.join(offsets, ["file", "stretch"]).withColumn(name, F.col("before") + own).drop("stretch", "before")


def step_of(token: Column) -> Column:
    """What a token adds to the nesting depth."""
    return F.when(token.isin("{", "["), 1).when(token.isin("}", "]"), -1).otherwise(0)


def occurrences(array: str, value: str) -> Column:
    """How often a value stands in an array; compiled, other than an aggregate by a lambda."""
    return F.size(array) - F.size(F.array_remove(array, value))


def json_texts(lines: DataFrame) -> DataFrame:
    """``file``, ``number`` (from 0) and ``json``, for every JSON value of numbered lines.

    Values may follow each other on a line, with or without white space between, and may spread over lines. A
    value ends where a token leaves no bracket open. A line inside one value is kept whole; others are cut by
    their tokens. White space outside strings is not kept. A last value that does not end is left out.
    """
    tokens = F.regexp_extract_all("value", F.lit(TOKEN), F.lit(0))
    cut = lines.select("file", "line", tokens.alias("tokens")).where(F.size("tokens") > 0)
    delta = occurrences("tokens", "{") + occurrences("tokens", "[") - occurrences("tokens", "}") - occurrences("tokens", "]")
    deep = with_total_before(cut.withColumn("delta", delta.cast("long")), "delta", "depth")

    start = F.struct(F.col("depth"), F.lit(0).cast("long").alias("ends"))

    def count(state: Column, token: Column) -> Column:
        depth = state["depth"] + step_of(token)
        return F.struct(depth.alias("depth"), (state["ends"] + F.when(depth == 0, 1).otherwise(0)).alias("ends"))

    ends = F.aggregate("tokens", start, count)["ends"]
    folder = f"{work_folder(lines.sparkSession)}/json-{uuid4().hex}"
    counted = with_total_before(deep.withColumn("ends", ends), "ends", "number").drop("delta")
    counted.write.parquet(folder)
    stored = lines.sparkSession.read.schema(counted.schema).parquet(folder)

    whole = stored.where(F.col("ends") == 0).select("file", "line", "number", F.array_join("tokens", "").alias("text"), F.lit(False).alias("ended"))
    spread = stored.where(F.col("ends") > 0).select("file", "line", "number", "depth", F.posexplode("tokens").alias("place", "token"))
    order = Window.partitionBy("file", "line").orderBy("place")
    placed = spread.withColumn("ended", F.col("depth") + F.sum(step_of(F.col("token"))).over(order) == 0)
    earlier = F.coalesce(F.sum(F.col("ended").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = placed.withColumn("number", F.col("number") + earlier).groupBy("file", "line", "number")
    cut_text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "token"))), lambda e: e["token"]), "")
    parts = whole.unionByName(pieces.agg(cut_text.alias("text"), F.bool_or("ended").alias("ended")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "text"))), lambda e: e["text"]), "")
    values = parts.groupBy("file", "number").agg(text.alias("json"), F.bool_or("ended").alias("ended"))
    return values.where("ended").select("file", "number", "json")
