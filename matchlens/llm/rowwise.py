"""One result row per text, computed in Arrow batches inside the tasks.

Only the id and the text leave the JVM, whatever other columns a frame has, so
extra columns cannot clash with results. Texts become Python strings a few
hundred at a time, which keeps memory low where texts are very long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

#: Rows that are Python objects at a time.
STEP = 256
#: Bytes of rows that go to a worker at a time: by rows alone, a batch grows with its texts.
BATCH = 8 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have the session send batches of at most ``BATCH`` bytes, or one row, unless its limit is lower or has been set in units."""
    now = spark.conf.get(_LIMIT).removesuffix("b")
    if now.lstrip("-").isdigit() and not 0 < int(now) <= BATCH:
        spark.conf.set(_LIMIT, str(BATCH))


def map_texts(df: DataFrame, key: str, text: str, fields: StructType, maker: Callable[[], Callable]) -> DataFrame:
    """``key`` and ``fields`` for every row of ``df``.

    ``maker`` runs once per task and returns the function of one text (None
    where it is null) that gives the tuple of ``fields``. It must be importable
    in the workers: a module's function or a partial of one. Nothing is
    shuffled and every row of ``df`` gives exactly one row.
    """
    source = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = StructType([StructField(key, df.schema[key].dataType), *fields.fields])
    types = [to_arrow_type(f.dataType) for f in fields.fields]
    return source.mapInArrow(partial(_rows, maker, [f.name for f in schema.fields], types), schema)


def _rows(maker: Callable, names: list[str], types: list, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = maker()
    for batch in batches:
        for at in range(0, batch.num_rows, STEP):
            part = batch.slice(at, STEP)
            made = [make(text) for text in part.column(1).to_pylist()]
            columns = [pa.array([row[i] for row in made], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)
