"""Statistics by place and day of the year: of all values, of daily means, of rolling means of days."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# The percentiles of the published statistics, by column name.
PERCENTILES = {"p05": 0.05, "p10": 0.10, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95}


def day_statistics(df: DataFrame, place: str, time: str, value: str) -> DataFrame:
    """One row per place, month and day over all years: count, first and last time, and the spread of the values.

    NULL and NaN values do not count.  Percentiles interpolate between the two nearest values.
    """
    at, number = F.col(f"`{time}`"), F.col(f"`{value}`").cast("double")
    number = F.when(~F.isnan(number), number)
    grouped = (
        df.select(F.col(f"`{place}`"), at.alias("at"), number.alias("v"))
        .where(F.col("v").isNotNull())
        .groupBy(F.col(f"`{place}`"), F.month("at").alias("month_nu"), F.dayofmonth("at").alias("day_nu"))
    )
    return grouped.agg(
        F.count("v").alias("count_nu"),
        F.min("at").alias("earliest"),
        F.max("at").alias("latest"),
        F.max("v").alias("max"),
        F.avg("v").alias("mean"),
        F.min("v").alias("min"),
        F.percentile("v", F.array(*[F.lit(share) for share in PERCENTILES.values()])).alias("quantiles"),
        F.stddev_samp("v").alias("std"),
    ).select(
        place, "month_nu", "day_nu", "count_nu", "earliest", "latest", "max", "mean", "min",
        *[F.col("quantiles")[k].alias(name) for k, name in enumerate(PERCENTILES)],
        "std",
    )


def _counted(df: DataFrame, place: str, time: str, value: str) -> DataFrame:
    """Place, month, day, time and value of the rows that count."""
    number = F.col(f"`{value}`").cast("double")
    at = F.col(f"`{time}`")
    rows = df.select(F.col(f"`{place}`"), F.month(at).alias("month_nu"), F.dayofmonth(at).alias("day_nu"), at.alias("at"), number.alias("v"))
    return rows.where(F.col("v").isNotNull() & ~F.isnan("v"))


def statistics_state(df: DataFrame, place: str, time: str, value: str, exact: bool = True) -> DataFrame:
    """What has to be kept of a delivery so that statistics can take in later ones without its rows.

    ``exact``: each place, month and day with its distinct values and how often they occur; as small as the values
    repeat.  Otherwise one row each: count, mean, second moment, extremes and a quantile sketch (KLL), whose
    percentiles are off by about a hundredth of the ranks and which has a bounded size.
    """
    rows = _counted(df, place, time, value)
    keys = [F.col(f"`{place}`"), "month_nu", "day_nu"]
    if exact:
        return rows.groupBy(*keys, "v").agg(F.count("v").alias("n"), F.min("at").alias("earliest"), F.max("at").alias("latest"))
    return rows.groupBy(*keys).agg(
        F.count("v").alias("n"),
        F.min("at").alias("earliest"),
        F.max("at").alias("latest"),
        F.max("v").alias("max"),
        F.avg("v").alias("mean"),
        F.min("v").alias("min"),
        (F.var_pop("v") * F.count("v")).alias("m2"),
        F.kll_sketch_agg_double("v").alias("sketch"),
    )


def merge_states(states: DataFrame, place: str) -> DataFrame:
    """One state from the rows of several, in any order; a state merged with nothing is itself."""
    keys = [F.col(f"`{place}`"), "month_nu", "day_nu"]
    times = [F.min("earliest").alias("earliest"), F.max("latest").alias("latest")]
    if "v" in states.columns:
        return states.groupBy(*keys, "v").agg(F.sum("n").alias("n"), *times)
    # A place and day has as many rows as states are merged; moments are joined pair by pair, which loses no digits.
    parts = F.sort_array(F.collect_list(F.struct("n", "mean", "m2")))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def joined(held: Column, part: Column) -> Column:
        n = held["n"] + part["n"]
        apart = part["mean"] - held["mean"]
        return F.struct(
            n.alias("n"),
            (held["mean"] + apart * part["n"] / n).alias("mean"),
            (held["m2"] + part["m2"] + apart * apart * held["n"] * part["n"] / n).alias("m2"),
        )

    merged = states.groupBy(*keys).agg(
        F.aggregate(parts, start, joined).alias("moments"),
        *times,
        F.max("max").alias("max"),
        F.min("min").alias("min"),
        F.kll_merge_agg_double("sketch").alias("sketch"),
    )
    return merged.select(
        F.col(f"`{place}`"), "month_nu", "day_nu", "moments.n", "earliest", "latest", "max", "moments.mean", "min", "moments.m2", "sketch"
    )


def statistics_of_state(state: DataFrame, place: str) -> DataFrame:
    """The columns of ``day_statistics``, from a state: with an exact one the same values."""
    keys = [F.col(f"`{place}`"), "month_nu", "day_nu"]
    shares = F.array(*[F.lit(share) for share in PERCENTILES.values()])
    if "v" in state.columns:
        means = state.groupBy(*keys).agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean"))
        around = state.join(means, [place, "month_nu", "day_nu"])
        square = (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean")) * F.col("n")
        found = around.groupBy(*keys).agg(
            F.sum("n").alias("count_nu"),
            F.min("earliest").alias("earliest"),
            F.max("latest").alias("latest"),
            F.max("v").alias("max"),
            F.first("mean").alias("mean"),
            F.min("v").alias("min"),
            F.percentile("v", shares, F.col("n")).alias("quantiles"),
            F.sum(square).alias("m2"),
        )
    else:
        found = state.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", shares)).withColumnRenamed("n", "count_nu")
    spread = F.when(F.col("count_nu") > 1, F.sqrt(F.col("m2") / (F.col("count_nu") - 1)))
    return found.select(
        place, "month_nu", "day_nu", "count_nu", "earliest", "latest", "max", "mean", "min",
        *[F.col("quantiles")[k].alias(name) for k, name in enumerate(PERCENTILES)],
        spread.alias("std"),
    )


def daily_means(df: DataFrame, place: str, time: str, value: str) -> DataFrame:
    """``place``, ``time`` (the day, at midnight) and the mean of the day; NULL and NaN do not count."""
    number: Column = F.col(f"`{value}`").cast("double")
    day = F.date_trunc("day", F.col(f"`{time}`"))
    return (
        df.where(number.isNotNull() & ~F.isnan(number))
        .groupBy(F.col(f"`{place}`"), day.alias(time))
        .agg(F.avg(number).alias(value))
    )


def rolling_means(days: DataFrame, place: str, time: str, value: str, window_days: int = 7) -> DataFrame:
    """The mean of each day and those of the ``window_days`` - 1 calendar days before it that have a value."""
    number = F.unix_date(F.to_date(F.col(f"`{time}`")))
    window = Window.partitionBy(F.col(f"`{place}`")).orderBy(number).rangeBetween(1 - window_days, 0)
    return days.select(place, time, F.avg(F.col(f"`{value}`")).over(window).alias(value))
