"""Run history, stage states, freshness and source coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.config import DEFAULT_BUDGET_DAYS, MART_BUDGET_DAYS, STAGES
from geopulse.functions.timefns import days_behind, hours_behind
from geopulse.operators.dedup import latest_per_group


def _count(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).cast("long")


def run_totals(runs: DataFrame) -> DataFrame:
    """Totals and the newest run of every workflow, in one aggregate."""
    ok = F.col("status") == "success"
    newest = F.max(F.struct("started_at", "run_id", "status", "duration_s", "rows_written")).alias("newest")
    totals = runs.groupBy("workflow").agg(
        F.count(F.lit(1)).alias("runs"),
        _count(ok).alias("ok"),
        F.max("started_at").alias("last_run"),
        F.max(F.when(ok, F.col("started_at"))).alias("last_ok"),
        F.sum("rows_written").alias("rows_total"),
        F.sum("failed_units").alias("failed_units"),
        newest,
    )
    return totals.select(
        "workflow", "runs", "ok", "last_run", "last_ok", "rows_total", "failed_units",
        F.col("newest.status").alias("last_status"), F.col("newest.duration_s").alias("duration_s"),
        F.col("newest.rows_written").alias("last_rows"),
    )


def latest_run(runs: DataFrame) -> DataFrame:
    return latest_per_group(runs, "workflow", "started_at", ["run_id", "status", "rows_written"])


def runs_by_status(runs: DataFrame) -> DataFrame:
    return runs.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def run_log(runs: DataFrame, k: int = 25) -> DataFrame:
    """Newest runs first; runs that never started come last."""
    ordered = runs.orderBy(F.desc_nulls_last("started_at"), "run_id").limit(k)
    return ordered.select("workflow", "status", "started_at", "duration_s", "rows_written", "failed_units")


def stage_table(spark, stages=STAGES) -> DataFrame:
    return spark.createDataFrame(list(stages), "stage string, workflow string, budget_hours int")


def stage_states(runs: DataFrame, stages: DataFrame, asof: Column) -> DataFrame:
    """State of each stage from the run history: live, overdue, failed, unrecorded or external."""
    joined = stages.join(run_totals(runs), "workflow", "left").withColumn(
        "age_hours", hours_behind(F.col("last_run"), asof)
    )
    joined = joined.withColumn("age_hours", F.when(F.col("last_run").isNotNull(), F.col("age_hours")))
    state = (
        F.when(F.col("workflow").isNull(), "external")
        .when(F.col("runs").isNull(), "unrecorded")
        .when(F.col("last_status") != "success", "failed")
        .when(F.col("age_hours") > F.col("budget_hours"), "overdue")
        .otherwise("live")
    )
    return joined.select(
        "stage", "workflow", state.alias("state"), "last_run", "age_hours", "duration_s",
        F.col("last_rows").alias("rows"), "failed_units", F.coalesce("runs", F.lit(0)).alias("runs"),
        (F.col("ok") / F.col("runs")).alias("success_rate"),
    )


def stage_rollup(states: DataFrame) -> DataFrame:
    return states.agg(
        _count(F.col("state").isin("failed", "overdue", "unrecorded")).alias("need_attention"),
        _count(F.col("state") == "unrecorded").alias("unrecorded"),
        F.min("age_hours").alias("freshest_hours"),
    )


def mart_freshness(status: DataFrame, asof: Column, budgets=MART_BUDGET_DAYS) -> DataFrame:
    """Days behind and day budget of each dated table."""
    pairs = [F.lit(item) for pair in budgets.items() for item in pair]
    budget = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("table")), F.lit(DEFAULT_BUDGET_DAYS))
    behind = F.when(F.col("last_value").isNotNull(), days_behind(F.col("last_value"), asof))
    return status.select(
        "table", "present", "rows", "last_value", behind.alias("days_behind"), budget.alias("budget_days"),
        (behind > budget).alias("late"),
    )


def mart_rollup(freshness: DataFrame) -> DataFrame:
    return freshness.agg(_count(F.col("late")).alias("late"), _count(~F.col("present")).alias("absent"))


def ops_report(runs: DataFrame, status: DataFrame, predictions: DataFrame) -> DataFrame:
    """Headline numbers of the operations page, as one row."""
    from geopulse.plans.serving import current_model

    tables = status.agg(_count(F.col("present")).alias("tables"), F.sum("rows").alias("rows"))
    facts = runs.agg(
        F.count(F.lit(1)).alias("runs"),
        F.avg((F.col("status") == "success").cast("int")).alias("success_rate"),
        F.max("started_at").alias("last_run"),
    )
    totals = tables.select(F.struct("tables", "rows")).scalar()
    return facts.withColumns(
        {
            "tables": totals["tables"],
            "table_rows": totals["rows"],
            "model_version": current_model(predictions).select("model_version").scalar(),
        }
    )


def health(status: DataFrame, core: str) -> DataFrame:
    """Registered tables with their rows, and whether the core one is there."""
    core_there = F.max((F.col("present") & (F.col("table") == core)).cast("int")).over(Window.partitionBy(F.lit(1)))
    return status.select("table", "present", "rows", (core_there == 1).alias("healthy"))  # a row for each table


def marts_by_source(registry: DataFrame) -> DataFrame:
    """Tables each source reaches, from a registry of ``(table, source_ids)``; bounded by the registry."""
    pairs = registry.select(F.explode("source_ids").alias("source_id"), "table").distinct()
    return pairs.groupBy("source_id").agg(F.sort_array(F.collect_list("table")).alias("served_by"))


def source_flow(sources: DataFrame, registry: DataFrame) -> DataFrame:
    """Credential state, metric count and reach of every source.

    A source whose credentials are all missing is blocked; unreadable JSON counts as none declared.
    """
    credentials = F.coalesce(F.from_json("credentials", "map<string,string>"), F.create_map().cast("map<string,string>"))
    present = lambda state: F.coalesce(state.isin("set", "present", "true"), F.lit(False))
    states = F.map_values("_credentials")
    metrics = F.coalesce(F.size(F.from_json("metric_types", "array<string>")), F.lit(0))
    staged = sources.withColumn("_credentials", credentials)
    joined = staged.join(marts_by_source(registry), "source_id", "left")
    return joined.select(
        "source_id", "label",
        F.greatest(metrics, F.lit(0)).alias("metrics"),
        F.size("_credentials").alias("credentials"),
        F.size(F.filter(states, present)).alias("credentials_present"),
        ((F.size("_credentials") > 0) & ~F.exists(states, present)).alias("blocked"),
        F.coalesce("served_by", F.array().cast("array<string>")).alias("served_by"),
    )


def coverage_by_domain(status: DataFrame, registry: DataFrame) -> DataFrame:
    """Present and total published tables per domain; internal tables do not count."""
    joined = registry.where(~F.col("internal")).join(status.select("table", "present"), "table", "left")
    here = F.coalesce(F.col("present"), F.lit(False))
    return joined.groupBy("domain").agg(
        _count(here).alias("present"), F.count(F.lit(1)).alias("total"), F.max(here).alias("live")
    )


def collection_summary(outcomes: DataFrame) -> DataFrame:
    """Rows, failed units and overall status per run, from its per-unit outcomes."""
    facts = outcomes.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("units"),
        _count(F.col("ok")).alias("ok_units"),
        _count(~F.col("ok")).alias("failed_units"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_written"),
    )
    status = (
        F.when(F.col("failed_units") == 0, "success").when(F.col("ok_units") > 0, "partial").otherwise("failed")
    )
    return facts.withColumn("status", status)


def run_records(runs: DataFrame) -> DataFrame:
    """Run rows ready for the history: duration in seconds and details as JSON text."""
    duration = (F.unix_micros("finished_at") - F.unix_micros("started_at")) / F.lit(1000000.0)
    return runs.withColumns({"duration_s": F.round(duration, 3), "details": F.to_json("details")})
