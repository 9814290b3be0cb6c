"""Sinks of the statistics documents and of result tables."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlens.operators.cohorts import COHORT
from matchlens.session import work_folder


def write_documents(documents: DataFrame, path: str, queue: str, form: str = "parquet") -> None:
    """Replace a queue's documents, one folder per cohort.

    A cohort's few documents are written by one task, in order of their score.
    """
    target = f"{path}/queue={queue}"
    if COHORT not in documents.columns:
        documents.coalesce(1).write.mode("overwrite").format(form).save(target)
        return
    sorted_by_cohort = documents.repartition(COHORT).sortWithinPartitions(
        COHORT, F.desc_nulls_last("score")
    )
    sorted_by_cohort.write.mode("overwrite").partitionBy(COHORT).format(form).save(target)


def write_collections(
    documents: DataFrame,
    database: str,
    prefix: str,
    cohorts: tuple[str, ...],
    options: dict[str, str],
    form: str = "mongodb",
) -> None:
    """Replace one collection per cohort; ``mongodb`` needs the store's Spark connector.

    The documents are computed once, into a folder per cohort of the shared
    work folder; each collection is filled from its own.
    """
    folder = f"{work_folder(documents.sparkSession)}/collections-{uuid4().hex}"
    documents.write.partitionBy(COHORT).parquet(folder)
    stored = documents.sparkSession.read.schema(documents.schema).parquet(folder)
    for cohort in cohorts:
        one = stored.where(F.col(COHORT) == cohort).drop(COHORT)
        named = {"database": database, "collection": f"{prefix}_{cohort}", **options}
        if "path" in named:
            named["path"] = f"{named['path']}/{database}/{prefix}_{cohort}"
        one.write.format(form).mode("overwrite").options(**named).save()


def write_table_json(df: DataFrame, path: str) -> None:
    """Result table as JSON in UTF-8, text as it is."""
    df.write.mode("overwrite").option("encoding", "UTF-8").json(path)
