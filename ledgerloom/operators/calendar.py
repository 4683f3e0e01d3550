"""Date ranges of number sequences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def sequence_month_ranges(sequences: DataFrame, first: dt.date, last: dt.date, name_part: str = "Advance") -> DataFrame:
    """(sequence, first day, last day) for every month from first to last of the sequences so named."""
    chosen = sequences.where(F.contains(F.col("name"), F.lit(name_part)))
    months = F.sequence(F.trunc(F.lit(first), "MM"), F.trunc(F.lit(last), "MM"), F.expr("INTERVAL 1 MONTH"))
    starts = chosen.select(F.col("id").alias("sequence_id"), F.explode(months).alias("date_from"))
    return starts.withColumn("date_to", F.last_day("date_from"))
