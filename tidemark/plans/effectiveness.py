"""Effectiveness metrics (DOM-4) and the period report (DOM-7).

One grouped aggregate per period and direction replaces the original's
sixteen actions per metric set, over daily cells of the forecasts; periods
are joined to the cells by day (JON-8).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.periods import assign_periods

EXIT_NAMES = ("50", "90", "100")
DIRECTIONS = ((1, "rise"), (2, "fall"))
# Order of the sixteen per-period metrics in the report.
PERIOD_METRICS = (
    ["min_date", "max_date", "rise_forecasts", "fall_forecasts"]
    + [f"{d}_{kind}_{e}" for _, d in DIRECTIONS for e in EXIT_NAMES for kind in ("success_pct", "yield")]
)
TOTAL_METRICS = ["all_forecasts", "ru_forecasts", "other_forecasts"]
HOME_COUNTRY = "RU"


def daily_cells(scored: DataFrame) -> DataFrame:
    """Counts and sums per (start date, direction, country): what every period adds up.

    At most days x 2 x countries rows, whatever the number of forecasts.
    """
    home = F.when(F.col("country_id") == HOME_COUNTRY, F.lit(True)).when(F.col("country_id").isNotNull(), F.lit(False))
    home = home if "country_id" in scored.columns else F.lit(None).cast("boolean")
    aggs = [F.count(F.lit(1)).alias("forecasts")]
    for e in EXIT_NAMES:
        aggs += [F.count_if(F.col("res" + e) >= 1).alias("success" + e),
                 F.sum("proc" + e).alias("sum" + e), F.count("proc" + e).alias("n" + e)]
    return scored.groupBy("start_date", F.col("forecast_direction").alias("direction"), home.alias("home")).agg(*aggs)


def forecast_metrics(scored: DataFrame, periods: DataFrame) -> DataFrame:
    """DOM-4 tidy: one row per (period, direction).

    Counts, min/max start date, and per exit the success count (code >= 1)
    and the mean daily yield over all forecasts of the direction. Empty
    periods keep their rows with zero counts and NULL means (Q4).
    """
    p = assign_periods(daily_cells(scored), periods, "start_date")
    aggs = [F.sum("forecasts").alias("forecasts"),
            F.min("start_date").alias("min_start_date"),
            F.max("start_date").alias("max_start_date")]
    for e in EXIT_NAMES:
        aggs += [F.sum("success" + e).alias("success" + e),
                 F.try_divide(F.sum("sum" + e), F.sum("n" + e)).alias("yield" + e)]
    m = p.groupBy("period_id", "direction").agg(*aggs)
    grid = periods.select("period_id", "period",
                          F.explode(F.array(*[F.lit(d) for d, _ in DIRECTIONS])).alias("direction"))
    out = grid.join(m, ["period_id", "direction"], "left")
    counts = ["forecasts"] + ["success" + e for e in EXIT_NAMES]
    return out.select("period_id", "period", "direction",
                      *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counts],
                      "min_start_date", "max_start_date",
                      *["yield" + e for e in EXIT_NAMES])


TOTAL_PERIOD_ID = -1
# Line of the first metric of period 0.
FIRST_PERIOD_LINE = 11


def effectiveness_report(scored: DataFrame, periods: DataFrame) -> DataFrame:
    """DOM-7 tidy: ``line, period, metric, value, value_date``.

    Lines 1-3 are the totals (all, home country, others); each period then
    contributes sixteen metric lines. Percentages are unrounded doubles
    (``render_report`` rounds for display, Q12); an empty period yields
    NULL values instead of an error (Q4).

    The scored forecasts are aggregated once, to daily cells; the totals ride
    along as an extra unbounded period, and a single ``stack`` unpivots the
    wide row of each period.
    """
    total = periods.sparkSession.createDataFrame(
        [(TOTAL_PERIOD_ID, "total", None, None, True)], periods.schema)
    per = periods.unionByName(total)
    p = assign_periods(daily_cells(scored), per, "start_date")
    rise, fall = F.col("direction") == 1, F.col("direction") == 2
    total_of = lambda cond, c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0))
    n_rise, n_fall = total_of(rise, "forecasts"), total_of(fall, "forecasts")
    aggs = [F.sum("forecasts").cast("double").alias("all_forecasts"),
            total_of(F.col("home"), "forecasts").cast("double").alias("ru_forecasts"),
            total_of(~F.col("home"), "forecasts").cast("double").alias("other_forecasts"),
            F.min(F.when(rise, F.col("start_date"))).alias("min_date"),
            F.max(F.when(rise, F.col("start_date"))).alias("max_date"),
            n_rise.cast("double").alias("rise_forecasts"),
            n_fall.cast("double").alias("fall_forecasts")]
    for cond, total_n, d in ((rise, n_rise, "rise"), (fall, n_fall, "fall")):
        for e in EXIT_NAMES:
            aggs.append(F.try_divide(F.lit(100.0) * total_of(cond, "success" + e), total_n).alias(f"{d}_success_pct_{e}"))
            aggs.append(F.try_divide(F.sum(F.when(cond, F.col("sum" + e))), F.sum(F.when(cond, F.col("n" + e)))).alias(f"{d}_yield_{e}"))
    wide = p.groupBy("period_id").agg(*aggs)
    wide = per.select("period_id", "period").join(wide, "period_id", "left")

    entries = [(i + 1, m, f"`{m}`", "NULL") for i, m in enumerate(TOTAL_METRICS)]
    entries += [(10 + i + 1, m, "NULL", f"`{m}`") for i, m in enumerate(PERIOD_METRICS[:2])]
    entries += [(10 + i + 3, m, f"CAST(`{m}` AS DOUBLE)", "NULL") for i, m in enumerate(PERIOD_METRICS[2:])]
    body = ", ".join(f"{pos}, '{m}', {v}, CAST({d} AS DATE)" for pos, m, v, d in entries)
    long = wide.selectExpr("period_id", "period",
                           f"stack({len(entries)}, {body}) as (pos, metric, value, value_date)")
    is_total_metric = F.col("metric").isin(*TOTAL_METRICS)
    long = long.filter((F.col("period_id") == TOTAL_PERIOD_ID) == is_total_metric)
    line = F.when(F.col("period_id") == TOTAL_PERIOD_ID, F.col("pos")).otherwise(
        F.col("period_id") * 20 + F.col("pos"))
    return long.select(line.cast("int").alias("line"), "period", "metric",
                       F.col("value").cast("double").alias("value"), "value_date")


def render_report(report: DataFrame, headings: bool = False) -> DataFrame:
    """SCL-30 / AGG-13: the two-column text rendering (rounded for display).

    With ``headings`` each period has a line with its name before its metrics,
    and an empty line before that from the second period on.
    """
    pct = F.col("metric").contains("success_pct")
    text = (F.when(F.col("value_date").isNotNull(), F.date_format("value_date", "yyyy-MM-dd"))
            .when(F.col("value").isNull(), F.lit(None).cast("string"))
            .when(pct, F.format_string("%.1f", F.round("value", 1)))
            .when(F.col("metric").contains("yield"), F.format_string("%.3f", F.round("value", 3)))
            .otherwise(F.col("value").cast("long").cast("string")))
    label = F.col("metric") if headings else F.concat_ws(" ", "period", "metric")
    out = report.select("line", label.alias("parameter"), F.coalesce(text, F.lit("")).alias("value"))
    if not headings:
        return out
    first = report.filter(F.col("metric") == PERIOD_METRICS[0])  # one row per period, its first line
    heads = first.select((F.col("line") - 1).alias("line"), F.col("period").alias("parameter"), F.lit("").alias("value"))
    blanks = first.filter(F.col("line") > FIRST_PERIOD_LINE).select((F.col("line") - 2).alias("line"), F.lit("").alias("parameter"), F.lit("").alias("value"))
    return out.unionByName(heads).unionByName(blanks)
