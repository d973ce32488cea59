"""SRC-5: the generated date dimension (FN-5..8, FN-13)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import schema as S


def dim_date(spark: SparkSession, start: dt.date = S.DIM_DATE_START,
             end: dt.date = S.DIM_DATE_END) -> DataFrame:
    """One row per day, ``start``..``end`` inclusive (6,940 rows by default).

    Full month and day names (``MMMM`` / ``EEEE``), ISO week, ISO day of
    week (1 = Monday) and a weekend flag for Saturday and Sunday.
    """
    d = F.col("full_date")
    days = F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY")))
    return spark.range(1).select(days.alias("full_date")).select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_id"),
        d,
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week"),
        F.dayofmonth(d).alias("day"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        (F.weekday(d) >= 5).alias("is_weekend"),
    )
