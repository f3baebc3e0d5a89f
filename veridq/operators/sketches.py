"""Mergeable profiles (P1, P5, V11 over time): sketches per day, merged for any span.

``daily`` reads a day's rows once and keeps one small row: counts, an HLL sketch per column
of distinct values and a KLL sketch per column of quantiles.  ``merge`` combines the rows of
any days without reading the data again; merging is associative, so profiles of batches,
days and months combine alike.

Stated errors: a distinct count is within ``DISTINCT_ERROR`` of the exact one (three standard
errors of 2^``LG_K`` registers); a quantile's rank is within ``RANK_ERROR`` of the one asked
for (99 % confidence at ``KLL_K``).  Counts of rows and missing values are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K, KLL_K = 12, 400
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
RANK_ERROR = 0.01


def daily(df: DataFrame, day: Column, distinct: list[str], quantiles: list[str]) -> DataFrame:
    """One row per day: n_rows; ``missing_c`` of every column; ``hll_c`` of those of
    ``distinct``; ``kll_c`` of those of ``quantiles`` (without NaN)."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in dict.fromkeys([*distinct, *quantiles])]
    aggs += [F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"hll_{c}") for c in distinct]
    number = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double"))
    aggs += [F.kll_sketch_agg_double(number(c), F.lit(KLL_K)).alias(f"kll_{c}") for c in quantiles]
    return df.groupBy(day.alias("day")).agg(*aggs)


def merge(profile: DataFrame, *by: Column) -> DataFrame:
    """Profiles combined within each group of ``by`` (all of them without)."""
    of = lambda start: [c for c in profile.columns if c.startswith(start)]
    aggs = [F.sum(c).alias(c) for c in ["n_rows", *of("missing_")]]
    aggs += [F.hll_union_agg(c).alias(c) for c in of("hll_")]
    aggs += [F.kll_merge_agg_double(c).alias(c) for c in of("kll_")]
    return profile.groupBy(*by).agg(*aggs)


def estimates(profile: DataFrame, at: tuple[float, ...] = (0.5,)) -> DataFrame:
    """``profile`` with ``distinct_c`` and ``q50_c`` (and so on) in place of its sketches."""
    out = []
    for c in profile.columns:
        if c.startswith("hll_"):
            out.append(F.hll_sketch_estimate(c).alias(f"distinct_{c[4:]}"))
        elif c.startswith("kll_"):
            some = F.kll_sketch_get_n_double(c) > 0  # a day without numbers has no quantile
            out += [F.when(some, F.kll_sketch_get_quantile_double(F.col(c), F.lit(p))).alias(f"q{round(100 * p)}_{c[4:]}") for p in at]
        else:
            out.append(F.col(c))
    return profile.select(*out)


def span(profile: DataFrame, first: str, last: str, at: tuple[float, ...] = (0.5,)) -> DataFrame:
    """Estimates over the days ``first`` to ``last``, from the stored rows alone."""
    return estimates(merge(profile.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))), at)


def weekly_check(events: DataFrame, stored: DataFrame, origin: str) -> DataFrame:
    """Weeks from ``origin``: exact counts of ``events`` beside the merged profile ``stored``,
    and whether its estimates are within the stated errors."""
    week = lambda day: F.floor(F.date_diff(day, F.lit(origin).cast("date")) / 7).cast("int").alias("week")
    guess = estimates(merge(stored, week(F.col("day"))))
    rows = events.select(week(F.to_date("ts")), "user_id", F.col("value"))
    met = rows.join(F.broadcast(guess.select("week", "q50_value")), "week")  # a row a week
    number = F.col("value").isNotNull() & ~F.isnan("value")
    exact = met.groupBy("week").agg(
        F.count(F.lit(1)).alias("rows_exact"), F.count_distinct("user_id").alias("n_users"), F.count_if(F.col("value").isNull()).alias("missing_exact"),
        F.count_if(number).alias("n_values"), F.count_if(number & (F.col("value") < F.col("q50_value"))).alias("below"), F.count_if(number & (F.col("value") <= F.col("q50_value"))).alias("up_to"))
    j = exact.join(guess, "week")
    return j.select(
        "week", F.col("n_rows").alias("n_events"), F.col("missing_value").alias("n_missing"), "n_users",
        (F.abs(F.col("distinct_user_id") - F.col("n_users")) <= DISTINCT_ERROR * F.col("n_users")).alias("users_within"),
        ((F.col("below") <= (0.5 + RANK_ERROR) * F.col("n_values")) & (F.col("up_to") >= (0.5 - RANK_ERROR) * F.col("n_values"))).alias("median_within"))
