"""Values far from the rolling mean of their own facility and indicator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.skew import HOT_ROWS
from tallymart.operators.framing import with_row_frame

# Fixed values.
SIGMAS = 3.0
MIN_ROWS = 3
FRAME_ROWS = 12


def sigma_anomalies(
    fact: DataFrame,
    sigmas: float = SIGMAS,
    min_rows: int = MIN_ROWS,
    rows: int = FRAME_ROWS,
    include_current: bool = True,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Positive values more than ``sigmas`` standard deviations off the rolling mean.

    The frame is the tested row and the ``rows - 1`` before it.  A row in its own frame holds its
    own deviation down: over n rows the score cannot exceed sqrt(n - 1), so 3 sigma takes 11 rows.
    ``include_current=False`` uses the ``rows`` rows before it instead.
    """
    value = F.col("numeric_value")
    place = ["ou_uid", "facility_name", "country_name", "district_name", "de_uid", "health_area", "period"]
    tested = fact.filter(value.isNotNull() & (value > 0) & ~F.col("is_missing_value"))
    # The rows of hot groups move and are written, so only what is read of them goes along.
    framed = with_row_frame(
        tested.select(*place, "coc_uid", "numeric_value"),
        ["ou_uid", "de_uid"],
        order=["period", "coc_uid"],
        frame=(-(rows - 1), 0) if include_current else (-rows, -1),
        inputs=["numeric_value"],
        aggregates={
            "_mean": F.avg(value),
            "_deviation": F.stddev_pop(value),
            "window_count": F.count(value),
        },
        hot_rows=hot_rows,
    )
    score = F.abs(value - F.col("_mean")) / F.col("_deviation")
    return (
        framed.filter((F.col("window_count") >= min_rows) & (F.col("_deviation") > 0))
        .withColumn("_score", score)
        .filter(F.col("_score") > sigmas)
        .select(
            *place,
            "numeric_value",
            F.round("_mean", 4).alias("rolling_mean"),
            F.round("_deviation", 4).alias("rolling_stddev"),
            F.round("_score", 2).alias("z_score"),
            "window_count",
        )
    )
