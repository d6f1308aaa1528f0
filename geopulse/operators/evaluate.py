"""Unsupervised evaluation: distributions, agreement with a rule, documented events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geopulse.config import DATA_CHANGE_TOLERANCE, RANK_THRESHOLD
from geopulse.operators import ranking

# Reported quantiles of a score distribution.
QUANTILES = {
    "score_p500": 0.5, "score_p750": 0.75, "score_p900": 0.9,
    "score_p950": 0.95, "score_p990": 0.99, "score_p999": 0.999,
}


def score_distribution(scored: DataFrame, score: str = "anomaly_score") -> DataFrame:
    ends = scored.agg(F.min(score).alias("lo"), F.max(score).alias("hi"))
    quantiles = ranking.linear_quantiles(scored, score, QUANTILES).drop("n")
    return quantiles.select(
        ends.select("lo").scalar().alias("score_min"), ends.select("hi").scalar().alias("score_max"), "*"
    )


def _with_cutoff(scored: DataFrame, score: str, top_fraction: float) -> DataFrame:
    cutoff = ranking.linear_quantiles(scored, score, {"cutoff": 1.0 - top_fraction})
    return scored.withColumn("_selected", F.col(score) >= cutoff.select("cutoff").scalar())


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def _agreement_columns(flag: str) -> list[Column]:
    selected, flagged = F.col("_selected"), F.coalesce(F.col(flag), F.lit(False))
    return [
        _count(selected).alias("model_selected"),
        _count(flagged).alias("reference_flagged"),
        _count(selected & flagged).alias("overlap"),
    ]


def _agreement_ratios() -> list[Column]:
    s, f, o = F.col("model_selected"), F.col("reference_flagged"), F.col("overlap")
    return [
        F.when(s > 0, o / s).otherwise(0.0).alias("precision_vs_reference"),
        F.when(f > 0, o / f).otherwise(0.0).alias("reference_recall"),
        (o / F.greatest(s + f - o, F.lit(1))).alias("jaccard"),
    ]


def agreement(scored: DataFrame, score: str, reference_flag: str, top_fraction: float) -> DataFrame:
    """Overlap of the top slice with an independent rule's flags: a comparator, never truth."""
    counted = _with_cutoff(scored, score, top_fraction).agg(*_agreement_columns(reference_flag))
    return counted.select("*", *_agreement_ratios())


def _separation_columns(value: str) -> list[Column]:
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v)
    return [
        F.avg(F.when(F.col("_selected"), v)).alias("flagged_mean"),
        F.coalesce(F.avg(F.when(~F.col("_selected"), v)), F.lit(0.0)).alias("rest_mean"),
    ]


def _separation_ratio() -> Column:
    ratio = F.when(F.col("rest_mean") != 0, F.col("flagged_mean") / F.col("rest_mean"))
    return ratio.otherwise(F.lit(float("inf"))).alias("ratio")


def separation(scored: DataFrame, score: str, value: str, top_fraction: float) -> DataFrame:
    """Mean of a physical quantity in the top slice against the rest."""
    means = _with_cutoff(scored, score, top_fraction).agg(*_separation_columns(value))
    return means.select("*", _separation_ratio())


def _concentration_column(score: str) -> Column:
    total = F.sum(score)
    share = F.sum(F.when(F.col("_selected"), F.col(score))) / total
    return F.when(total > 0, share).otherwise(0.0).alias("score_mass_in_top_slice")


def concentration(scored: DataFrame, score: str, top_fraction: float = 0.025) -> DataFrame:
    return _with_cutoff(scored, score, top_fraction).agg(_concentration_column(score))


def evaluate(scored: DataFrame, score: str, reference_flag: str, value: str, top_fraction: float = 0.025) -> DataFrame:
    """The full unsupervised report as one row, from one conditional aggregate."""
    if reference_flag not in scored.columns:
        raise KeyError(f"{reference_flag} is missing: a model must not be compared with its own flags")
    wanted = QUANTILES | {"_cut": 1.0 - top_fraction}
    at = ranking.linear_quantiles(scored, score, wanted).select(F.struct(*wanted)).scalar()  # one rank table, read once
    facts = scored.withColumn("_selected", F.col(score) >= at["_cut"]).agg(
        F.min(score).alias("score_min"), F.max(score).alias("score_max"),
        _concentration_column(score), *_separation_columns(value), *_agreement_columns(reference_flag),
    )
    ratios = facts.select("*", _separation_ratio(), *_agreement_ratios())
    ratios = ratios.withColumns({name: at[name] for name in QUANTILES})
    return ratios.withColumn("rederives_rule", F.col("precision_vs_reference") >= 0.99)


def flag_rate(scored: DataFrame, flag: str) -> DataFrame:
    """Rows scored, flagged, and the flag rate."""
    hit = F.coalesce(F.col(flag), F.lit(False)).cast("int")
    return scored.agg(
        F.count(F.lit(1)).alias("rows_scored"),
        F.coalesce(F.sum(hit), F.lit(0)).cast("long").alias("flagged"),
        F.avg(hit).alias("flag_rate"),
    )


def check_events(
    scored: DataFrame, events: DataFrame, score: str = "anomaly_percentile", flag: str = "is_anomaly",
    value: str = "detection_count", rank_threshold: float = RANK_THRESHOLD,
) -> DataFrame:
    """Verdict per documented event ``(event_id, region_id, start, end, recorded_peak, expected)``.

    Events are spread over their days, so the interval test is an equi-join on (region, day).
    """
    required = {"region_id", "observation_date", value, score, flag}
    missing = required - set(scored.columns)
    if missing:
        raise KeyError(f"event check needs {sorted(missing)}; frame has {scored.columns}")
    days = events.select(
        "event_id", "region_id", F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("observation_date")
    )
    facts = (
        days.join(scored.select("region_id", "observation_date", value, score, flag), ["region_id", "observation_date"])
        .groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("window_days"),
            F.max(value).cast("long").alias("max_detections"),
            _count(F.coalesce(F.col(flag), F.lit(False))).alias("flagged_days"),
            F.max(score).alias("max_percentile"),
        )
    )
    joined = events.join(facts, "event_id", "left")
    tolerated = F.floor(F.col("recorded_peak") * DATA_CHANGE_TOLERANCE)
    criterion = (
        F.when(F.col("window_days").isNull(), "no-data")
        .when(~F.col("expected") & (F.col("flagged_days") > 0), "flag")
        .when(~F.col("expected"), "clean")
        .when(F.col("max_detections") < tolerated, "data-changed")
        .when(F.col("flagged_days") > 0, "flag")
        .when(F.col("max_percentile") >= rank_threshold, "rank")
        .otherwise("missed")
    )
    detected = F.col("criterion").isin("flag", "rank")
    return (
        joined.withColumn("criterion", criterion)
        .withColumn("detected", detected)
        .withColumn("passed", F.col("detected") == F.col("expected"))
        .select(
            "event_id", "region_id", "start", "end", "expected", "detected", "passed", "criterion",
            F.coalesce("flagged_days", F.lit(0)).alias("flagged_days"),
            F.coalesce("window_days", F.lit(0)).alias("window_days"),
            F.coalesce("max_detections", F.lit(0)).alias("max_detections"),
            "recorded_peak", "max_percentile",
        )
    )


def event_pass_rate(outcomes: DataFrame) -> DataFrame:
    """Passed share of all events; ``evaluated = 0`` means the check said nothing."""
    return outcomes.agg(
        F.count(F.lit(1)).alias("events"),
        _count(F.col("criterion") != "no-data").alias("evaluated"),
        _count(F.col("passed")).alias("passed_events"),
        F.avg(F.col("passed").cast("int")).alias("pass_rate"),
    )
