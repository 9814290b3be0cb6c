"""Facts stored for the statistics: versions as partitions, tiers in order, matches in buckets.

The flatten job writes canonical tiers and ``major.minor`` versions, so that both filters of a
document are comparisons of stored columns: the version names partitions, and a tier skips row groups, as
rows are sorted by it inside a file. All rows of a match lie in one bucket, so match totals, bans and
pair statistics, which group by match first, need no exchange of facts.

Tiers are no partitions: a document reads all cohorts, and their folders would multiply the files of each bucket.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.operators.cohorts import with_canonical_values
from matchlens.session import work_folder

VERSION = "gameVersion"
MATCH = "matchId"
# Rows of a bucket, about.
BUCKET_ROWS = 20_000_000


def bucket_count(facts_rows: int, parallelism: int) -> int:
    """Buckets for a number of rows: no fewer than shuffles have partitions, or Spark would shuffle anew."""
    return max(parallelism, min(100_000, -(-facts_rows // BUCKET_ROWS)))


def write_fact_table(facts: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Replace a table of facts at ``path`` and return it.

    A matchless row is kept, in the bucket of NULL. Facts move once, by match, so that each bucket is one
    file of a version.
    """
    spark = facts.sparkSession
    canonical = with_canonical_values(facts).repartition(buckets, MATCH)
    writer = canonical.write.mode("overwrite").format("parquet").option("path", path)
    writer.partitionBy(VERSION).bucketBy(buckets, MATCH).sortBy("tier").saveAsTable(table)
    return spark.table(table)


def bucketed_facts(facts: DataFrame, columns: tuple[str, ...], rows: int | None = None) -> DataFrame:
    """The given columns of facts as a table of its own in the shared work folder."""
    spark = facts.sparkSession
    name = f"facts_{uuid4().hex}"
    parallelism = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = facts.select(*[c for c in columns if c in facts.columns])
    return write_fact_table(kept, name, f"{work_folder(spark)}/{name}", bucket_count(rows or 0, parallelism))


def append_day(facts: DataFrame, table: str) -> None:
    """Add rows to a stored table, by column name, in its partitions and buckets."""
    stored = facts.sparkSession.table(table)
    buckets = int(facts.sparkSession.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first()["data_type"])
    canonical = with_canonical_values(facts).select(stored.columns).repartition(buckets, F.col(MATCH))
    canonical.write.insertInto(table)
