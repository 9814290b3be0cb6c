"""Score calibration from published rankings.

Rankings are small per position; all positions are fitted in one aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlens.operators.joins import join_null_safe
from matchlens.operators.rows import rank_first

RECORD_LINES = 10

# Line of each field in a record; percentages end in a sign.
FIELD_LINES = {"name": 2, "score": 4, "h_score": 5, "win_rate": 6, "pick_rate": 7, "ban_rate": 8}

# Weights put in place of the fitted ones, by feature version.
WEIGHTS = {1: (1.5, 3.5), 2: (1.6, 5.5)}

SHOWN = [
    "name",
    "score",
    "predict",
    "score_rank",
    "predict_rank",
    "win_rate",
    "pick_rate",
    "ban_rate",
]


def parse_records(texts: DataFrame, text: str = "value", by: list[str] | None = None) -> DataFrame:
    """Rows from texts of ten-line records; an incomplete last record is left out."""
    by = by or []
    cut = texts.select(*by, F.split(text, "\n").alias("lines"))
    records = F.floor(F.size("lines") / RECORD_LINES).cast("int")
    starts = F.when(records > 0, F.sequence(F.lit(0), records - 1))

    def record(i: Column) -> Column:
        fields = [(i + 1).cast("bigint").alias("ordinal")]
        for name, line in FIELD_LINES.items():
            value = F.get("lines", i * RECORD_LINES + line)
            if name != "name":
                value = F.rtrim(value, F.lit("%")).try_cast("double")
            fields.append(value.alias(name))
        return F.struct(*fields)

    return cut.select(*by, F.inline(F.transform(starts, record)))


def records_of_lines(lines: DataFrame) -> DataFrame:
    """As :func:`parse_records`, of files whose lines are numbered: a row for each ten lines of a ``file``.

    A record may lie in two splits of its file; its lines meet by their number, ten in a group.
    """
    placed = lines.select("file", F.expr(f"line div {RECORD_LINES}").alias("record"), (F.col("line") % RECORD_LINES).alias("place"), "value")

    def field(name: str, line: int) -> Column:
        value = F.max(F.when(F.col("place") == line, F.col("value")))
        return (value if name == "name" else F.rtrim(value, F.lit("%")).try_cast("double")).alias(name)

    found = placed.groupBy("file", "record").agg(*[field(*f) for f in FIELD_LINES.items()], F.count("*").alias("lines"))
    complete = found.where(F.col("lines") == RECORD_LINES)
    return complete.select("file", (F.col("record") + 1).alias("ordinal"), *FIELD_LINES)


def features(records: DataFrame, by: list[str], version: int = 1) -> DataFrame:
    """``x1``, the win rate above even, and ``x2``, the presence above an even share."""
    sizes = records.groupBy(*by).agg(F.count("name").alias("n"))
    sized = join_null_safe(records, sizes, by)
    even = F.lit(200.0) / F.col("n")
    presence = F.ln(
        F.try_divide(
            F.try_divide(F.col("pick_rate"), F.lit(1.0) - F.col("ban_rate") / 100.0), even
        )
    )
    scale = F.ln(even) if version == 1 else F.sqrt(even)
    return sized.withColumns(
        {"x1": F.col("win_rate") - 50.0, "x2": F.try_divide(presence, scale)}
    ).na.fill(0.0)


def fit(df: DataFrame, by: list[str], x1: str = "x1", x2: str = "x2", y: str = "score") -> DataFrame:
    """Least squares of ``y`` on two features with an intercept, for every group at once.

    Dependent features get the coefficients of the smallest norm.
    """
    moments = df.groupBy(*by).agg(
        F.var_pop(x1).alias("v11"),
        F.var_pop(x2).alias("v22"),
        F.covar_pop(x1, x2).alias("v12"),
        F.covar_pop(x1, y).alias("c1"),
        F.covar_pop(x2, y).alias("c2"),
        F.avg(x1).alias("m1"),
        F.avg(x2).alias("m2"),
        F.avg(y).alias("my"),
    )
    v11, v22, v12, c1, c2 = map(F.col, ("v11", "v22", "v12", "c1", "c2"))
    det = v11 * v22 - v12 * v12
    trace = v11 + v22
    regular = det > 1e-12 * trace * trace
    along = F.coalesce(F.try_divide(v11 * c1 + v12 * c2, trace * trace), F.lit(0.0))
    across = F.coalesce(F.try_divide(v12 * c1 + v22 * c2, trace * trace), F.lit(0.0))
    coefficients = moments.withColumns(
        {
            "b1": F.when(regular, F.try_divide(v22 * c1 - v12 * c2, det)).otherwise(along),
            "b2": F.when(regular, F.try_divide(v11 * c2 - v12 * c1, det)).otherwise(across),
        }
    )
    intercept = F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")
    return coefficients.select(*by, intercept.alias("intercept"), "b1", "b2")


def predict(df: DataFrame, fitted: DataFrame, by: list[str], weights: tuple[float, float]) -> DataFrame:
    """Score from given weights and the fitted intercept."""
    joined = join_null_safe(df, fitted.select(*by, "intercept"), by)
    value = F.col("intercept") + weights[0] * F.col("x1") + weights[1] * F.col("x2")
    return joined.withColumn("predict", value).drop("intercept")


def compare_ranks(records: DataFrame, by: list[str], version: int = 1) -> DataFrame:
    """Published and predicted ranks side by side, by predicted rank."""
    made = features(records, by, version)
    predicted = predict(made, fit(made, by), by, WEIGHTS[version])
    ranked = rank_first(predicted, "score", "ordinal", "score_rank", by)
    ranked = rank_first(ranked, "predict", "ordinal", "predict_rank", by)
    return ranked.select(*by, *SHOWN).orderBy(*by, "predict_rank")
