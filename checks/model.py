"""Features, the isolation forest and its evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import CTES, check
from geopulse.operators import evaluate as ev
from geopulse.operators import features, forest
from geopulse.plans import training
from geopulse.sources.lake import dataset_revision
from geopulse.workspace import materialise

FEATURES = " ".join(f"{name}:f" for name in features.FEATURES)
FEATURE_SQL = ", ".join(features.FEATURES)


@check("causal_features", f"region_id observation_date:d {FEATURES} doy_sin:f doy_cos:f zscore:f is_anomaly", "select * from feature_table")
def _(t):
    return features.causal_features(t.fire, t.sst_daily)


@check("feature_matrix", f"region_id observation_date:d {FEATURES}",
       "select * from feature_table where " + " and ".join(f"{c} is not null" for c in features.FEATURES))
def _(t):
    return features.feature_matrix(t.feature_table)


@check("feature_matrix_zero", f"region_id observation_date:d {FEATURES}",
       "select region_id, observation_date, " + ", ".join(f"coalesce({c}, 0) as {c}" for c in features.FEATURES) + " from feature_table")
def _(t):
    return features.feature_matrix(t.feature_table, missing="zero")


@check("feature_report", "row_count:i usable_rows:i dropped_rows:i first_day:d last_day:d null_fraction_max:f regions:i",
       "select count(*) as row_count, count(*) filter (" + " and ".join(f"{c} is not null" for c in features.FEATURES) + ") as usable_rows, "
       "count(*) filter (" + " or ".join(f"{c} is null" for c in features.FEATURES) + ") as dropped_rows, "
       "min(observation_date) as first_day, max(observation_date) as last_day, greatest("
       + ", ".join(f"count(*) filter ({c} is null) / count(*)" for c in features.FEATURES)
       + ") as null_fraction_max, count(distinct region_id) as regions from feature_table")
def _(t):
    return features.feature_report(t.feature_table)


# -- forest: the digests that choose rows, features and cuts are the same in SQL -------------------


def _number(text: str) -> str:
    return f"cast('0x' || substr(md5({text}), 1, {forest.DIGITS}) as bigint)"


def _unit(what: str) -> str:
    text = f"'{forest.SEED}:' || tree || ':' || node || ':{what}'"
    return f"({_number(text)} / {16.0**forest.DIGITS!r})"


WIDE = len(features.FEATURES)
LOW, HIGH = (", ".join(f"{f}(x[{i}])" for i in range(1, WIDE + 1)) for f in ("min", "max"))
# What a node does with its rows, from the least and greatest value of every feature.
DECIDED = f"""
  select *, case when feature >= 0 then case when raw_cut > lo[feature + 1] then raw_cut else hi[feature + 1] end else 0e0 end as cut from (
    select *, case when feature >= 0 then lo[feature + 1] + {_unit("cut")} * (hi[feature + 1] - lo[feature + 1]) end as raw_cut from (
      select *, case when depth < 8 and n > 1 and len(open) > 0 then open[cast(floor({_unit("feature")} * len(open)) as int) + 1] else -1 end as feature from (
        select *, list_filter(range(0, {WIDE}), lambda i: hi[i + 1] > lo[i + 1]) as open from (
          select tree, node, depth, count(*) as n, [{LOW}] as lo, [{HIGH}] as hi, list({{'k': k, 'x': x}}) as members from MEMBERS group by 1, 2, 3))))"""
FOREST = {
    "matrix": f"""select region_id, observation_date, {_number("region_id || '|' || observation_date")} as k, [{", ".join(f"round(cast({c} as double) + 1e-9, 6)" for c in features.FEATURES)}] as x
                  from feature_table where {" and ".join(f"{c} is not null" for c in features.FEATURES)}""",
    "mixers": f"""select tree, 1 + {_number(f"'{forest.SEED}:' || tree || ':factor'")} % {forest.PRIME - 1} as a, {_number(f"'{forest.SEED}:' || tree || ':summand'")} % {forest.PRIME} as b
                  from (select unnest(range({forest.TREES})) as tree)""",
    "sampled": f"""select tree, k, x from (select tree, k, x, row_number() over (partition by tree order by (k % {forest.PRIME} * a + b) % {forest.PRIME}, k) as place from matrix, mixers)
                   where place <= {forest.SAMPLE_SIZE}""",
    "grown": f"""
        with recursive grow as (
          select tree, cast(0 as bigint) as node, 0 as depth, k, x from sampled
          union all
          select tree, 2 * node + case when m.x[feature + 1] < cut then 1 else 2 end, depth + 1, m.k, m.x
          from (select tree, node, depth, feature, cut, unnest(members) as m from ({DECIDED.replace("MEMBERS", "grow")}) d where feature >= 0) s)
        select * from grow""",
    "forest_nodes": f"""
        select tree, node, feature, cut, case when feature >= 0 then 2 * node + 1 else -1 end as below, case when feature >= 0 then 2 * node + 2 else -1 end as above,
               n as size, depth from ({DECIDED.replace("MEMBERS", "grown")}) d""",
    "leaf_lengths": """
        select *, depth + case when size > 2 then 2e0 * (ln(size - 1e0) + 0.5772156649015329e0) - 2e0 * (size - 1e0) / size when size = 2 then 1e0 else 0e0 end as length
        from forest_nodes""",
}


def _walked(rows: str) -> str:
    """Scores of rows with ``x``: every tree is walked one level a join."""
    at = f"select r.*, tree, cast(0 as bigint) as node from {rows} r, (select distinct tree from forest_nodes)"
    for _ in range(8):
        at = f"""select w.* exclude (node), case when n.feature < 0 then w.node when w.x[n.feature + 1] < n.cut then n.below else n.above end as node
                 from ({at}) w join forest_nodes n on n.tree = w.tree and n.node = w.node"""
    size = float(forest.expected_path([forest.SAMPLE_SIZE])[0])
    return f"""select region_id, observation_date, pow(2e0, -sum(length) / {forest.TREES}e0 / {size!r}) as anomaly_score
               from ({at}) w join leaf_lengths l on l.tree = w.tree and l.node = w.node group by 1, 2"""


FOREST["forest_scores"] = _walked("matrix")
CTES.update(FOREST)


def _matrix(t):
    # both engines add in their own order, so features are cut to six places before trees compare them
    matrix = features.feature_matrix(t.feature_table)
    return matrix.select(*features.KEYS, *[(F.round(F.col(c).cast("double") + 1e-9, 6)).alias(c) for c in features.FEATURES])


@check("fit_isolation_forest", "tree node:i feature:i cut:f below:i above:i size:i depth:i",
       "select cast(tree as int) as tree, node, feature, cut, below, above, size, depth from forest_nodes")
def _(t):
    return forest.fit_isolation_forest(_matrix(t), features.FEATURES, features.KEYS).nodes


COMPLETE = " and ".join(f"{c} is not null" for c in features.FEATURES)


@check("forest_invariants", "tree root_rows:i leaf_rows:i uneven_splits:i too_deep:i",
       f"""select tree, n as root_rows, n as leaf_rows, 0 as uneven_splits, 0 as too_deep
          from (select unnest(range({forest.TREES})) as tree), (select least({forest.SAMPLE_SIZE}, count(*)) as n from feature_table where {COMPLETE})""")
def _(t):
    # every tree: the rows it starts from, the rows of its leaves, splits whose children do not add up, nodes past the depth limit
    nodes = materialise(
        forest.fit_isolation_forest(features.feature_matrix(t.feature_table), features.FEATURES, features.KEYS).nodes, "forest"
    )
    child = nodes.select("tree", F.col("node").alias("child"), F.col("size").alias("child_size"))
    inner = nodes.where("feature >= 0").select("tree", "node", "size", F.explode(F.array("below", "above")).alias("child"))
    uneven = inner.join(child, ["tree", "child"]).groupBy("tree", "node", "size").agg(F.sum("child_size").alias("parts")).where("parts <> size")
    counted = nodes.groupBy("tree").agg(
        F.sum(F.when(F.col("node") == 0, F.col("size"))).alias("root_rows"), F.sum(F.when(F.col("feature") < 0, F.col("size"))).alias("leaf_rows"),
        F.count_if(F.col("depth") > 8).alias("too_deep"),
    )
    return counted.join(uneven.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree", "left").withColumn("uneven_splits", F.coalesce("n", F.lit(0)))


@check("score", "region_id observation_date:d anomaly_score:f", "select * from forest_scores")
def _(t):
    matrix = _matrix(t)
    fitted = forest.fit_isolation_forest(matrix, features.FEATURES, features.KEYS)
    return forest.score(matrix, fitted)


@check("predictions", "region_id observation_date:d model_version anomaly_score:f anomaly_percentile:f is_anomaly threshold:f dataset_commit region_kind scored_at:t")
def _(t):
    trained = training.train(t.feature_table)
    return training.batch_score(t.feature_table, trained, "rev-1", F.lit("2001-10-01").cast("timestamp"))


NAMES = "[" + ", ".join(f"''{name}''" for name in sorted(features.FEATURES)) + "]"


@check("prediction_labels", "region_id observation_date:d model_version dataset_commit region_kind scored_at:t scored:i",
       f"""select region_id, observation_date, '{forest.MODEL_KIND}:' || substr(sha256('{forest.MODEL_KIND}|rev-1|{NAMES}|{forest.TREES}|{forest.SEED}'), 1, 12) as model_version,
          'rev-1' as dataset_commit, 'fire' as region_kind, timestamp '2001-10-01' as scored_at, 1 as scored from feature_table""")
def _(t):
    trained = training.train(t.feature_table)
    out = training.batch_score(t.feature_table, trained, "rev-1", F.lit("2001-10-01").cast("timestamp"))
    fine = F.col("anomaly_score").between(0, 1) & F.col("anomaly_percentile").between(0, 1) & (
        F.col("is_anomaly") == (F.col("anomaly_percentile") >= F.col("threshold"))
    )
    return out.withColumn("scored", fine.cast("int"))


@check("reference_flag_kept", "region_id rows:i rule_flags:i matches:i",
       """select region_id, count(*) as rows, count(*) filter (is_anomaly) as rule_flags, count(*) as matches from feature_table
          where """ + " and ".join(f"{c} is not null" for c in features.FEATURES) + " group by 1")
def _(t):
    # the model's flags must leave the captured rule flag of every complete row untouched
    trained = training.train(t.feature_table)
    rule = t.feature_table.select("region_id", "observation_date", F.coalesce("is_anomaly", F.lit(False)).alias("rule"))
    return trained.scored.join(rule, ["region_id", "observation_date"]).groupBy("region_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("reference_is_anomaly").alias("rule_flags"),
        F.count_if(F.col("rule") == F.col("reference_is_anomaly")).alias("matches"),
    )


@check("flag_top", "region_id observation_date:d anomaly_percentile:f threshold:f model_is_anomaly",
       """select *, anomaly_percentile >= threshold as model_is_anomaly
          from (select *, (select quantile_cont(anomaly_percentile, 0.975) from scored) as threshold from scored)""")
def _(t):
    return forest.flag_top(t.scored.drop("anomaly_percentile"))


# -- evaluation -------------------------------------------------------------------------------


@check("score_distribution",
       "score_min:f score_max:f score_p500:f score_p750:f score_p900:f score_p950:f score_p990:f score_p999:f",
       "select min(anomaly_score) as score_min, max(anomaly_score) as score_max, "
       + ", ".join(f"quantile_cont(anomaly_score, {q}) as {n}" for n, q in ev.QUANTILES.items()) + " from scored")
def _(t):
    return ev.score_distribution(t.scored)


TOP = "(select *, anomaly_score >= (select quantile_cont(anomaly_score, 0.975) from scored) as sel from scored)"
AGREE = f"""select s as model_selected, f as reference_flagged, o as overlap, case when s > 0 then o / s else 0e0 end as precision_vs_reference,
  case when f > 0 then o / f else 0e0 end as reference_recall, o / greatest(s + f - o, 1) as jaccard
  from (select count(*) filter (sel) as s, count(*) filter (rule_flag) as f, count(*) filter (sel and rule_flag) as o from {TOP})"""


@check("agreement", "model_selected:i reference_flagged:i overlap:i precision_vs_reference:f reference_recall:f jaccard:f", AGREE)
def _(t):
    return ev.agreement(t.scored, "anomaly_score", "rule_flag", 0.025)


SEPARATE = f"""select a as flagged_mean, b as rest_mean, a / b as ratio
  from (select avg(detection_count) filter (sel) as a, avg(detection_count) filter (not sel) as b from {TOP})"""


@check("separation", "flagged_mean:f rest_mean:f ratio:f", SEPARATE)
def _(t):
    return ev.separation(t.scored, "anomaly_score", "detection_count", 0.025)


CONCENTRATE = f"select sum(anomaly_score) filter (sel) / sum(anomaly_score) as score_mass_in_top_slice from {TOP}"


@check("concentration", "score_mass_in_top_slice:f", CONCENTRATE)
def _(t):
    return ev.concentration(t.scored, "anomaly_score")


@check("evaluate",
       "score_min:f score_max:f score_p500:f score_p750:f score_p900:f score_p950:f score_p990:f score_p999:f score_mass_in_top_slice:f flagged_mean:f rest_mean:f ratio:f "
       "model_selected:i reference_flagged:i overlap:i precision_vs_reference:f reference_recall:f jaccard:f rederives_rule",
       f"""select *, precision_vs_reference >= 0.99 as rederives_rule
          from ({AGREE}) a, ({SEPARATE}) s, ({CONCENTRATE}) c,
          (select min(anomaly_score) as score_min, max(anomaly_score) as score_max,
           {", ".join(f"quantile_cont(anomaly_score, {q}) as {n}" for n, q in ev.QUANTILES.items())} from scored) d""")
def _(t):
    return ev.evaluate(t.scored, "anomaly_score", "rule_flag", "detection_count")


@check("flag_rate", "rows_scored:i flagged:i flag_rate:f",
       "select count(*) as rows_scored, count(*) filter (is_anomaly) as flagged, count(*) filter (is_anomaly) / count(*) as flag_rate from scored")
def _(t):
    return ev.flag_rate(t.scored, "is_anomaly")


# one event per customer: its first order day and the week after, with peaks only some of which the data still reach
EVENTS = """(select o_custkey as event_id, min_by(o_orderpriority, (o_orderdate, o_orderkey)) as region_id, cast(min(o_orderdate) as date) as "start",
  cast(min(o_orderdate) as date) + cast(o_custkey % 8 as int) as "end",
  o_custkey % 9 as recorded_peak, o_custkey % 5 <> 0 as expected from orders group by o_custkey)"""
VERDICT = f"""select e.*, coalesce(n, 0) as window_days, coalesce(d, 0) as max_detections, coalesce(f, 0) as flagged_days, p as max_percentile,
  case when n is null then 'no-data' when not expected and f > 0 then 'flag' when not expected then 'clean'
       when d < floor(recorded_peak * 0.6e0) then 'data-changed' when f > 0 then 'flag' when p >= 0.9 then 'rank' else 'missed' end as criterion
  from {EVENTS} e left join (
    select event_id, count(*) as n, max(detection_count) as d, count(*) filter (is_anomaly) as f, max(anomaly_percentile) as p
    from {EVENTS} x join scored s on s.region_id = x.region_id and s.observation_date between x."start" and x."end" group by 1) w
  on w.event_id = e.event_id"""


def events(t):
    k, day = F.col("o_custkey"), F.to_date("o_orderdate")
    return t.read("orders").groupBy(k.alias("event_id")).agg(
        F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("region_id"), F.min(day).alias("start")
    ).select(
        "event_id", "region_id", "start", F.date_add("start", (F.col("event_id") % 8).cast("int")).alias("end"),
        (F.col("event_id") % 9).alias("recorded_peak"), (F.col("event_id") % 5 != 0).alias("expected"),
    )


@check("check_events",
       "event_id region_id start:d end:d expected detected passed criterion flagged_days:i window_days:i max_detections:i recorded_peak max_percentile:f",
       f"""select *, criterion in ('flag', 'rank') as detected, (criterion in ('flag', 'rank')) = expected as passed from ({VERDICT})""")
def _(t):
    return ev.check_events(t.scored, events(t))


@check("event_pass_rate", "events:i evaluated:i passed_events:i pass_rate:f",
       f"""select count(*) as events, count(*) filter (criterion <> 'no-data') as evaluated,
          count(*) filter ((criterion in ('flag', 'rank')) = expected) as passed_events,
          count(*) filter ((criterion in ('flag', 'rank')) = expected) / count(*) as pass_rate from ({VERDICT})""")
def _(t):
    return ev.event_pass_rate(ev.check_events(t.scored, events(t)))


@check("dataset_revision", "length:i files:i again:i both:i",
       "select 12 as length, 2 as files, 1 as again, 1 as both from orders having count(*) > 0")
def _(t):
    # two tables differ, a table twice does not, and the order of files within a frame does not matter
    def named(df, name):
        return dataset_revision(df).withColumn("of", F.lit(name))

    orders, lines = t.read("orders"), t.read("lineitem")
    keys = orders.select(F.col("o_orderkey").alias("k")), lines.select(F.col("l_orderkey").alias("k"))
    rows = named(orders, "orders").unionByName(named(lines, "lineitem")).unionByName(named(t.read("orders"), "orders"))
    rows = rows.unionByName(named(keys[0].unionByName(keys[1]), "both")).unionByName(named(keys[1].unionByName(keys[0]), "both"))
    of = lambda name: F.count_distinct(F.when(F.col("of") == name, F.col("revision")))
    single = F.count_distinct(F.when(F.col("of") != "both", F.col("revision")))
    return rows.agg(F.max(F.length("revision")).alias("length"), single.alias("files"), of("orders").alias("again"), of("both").alias("both"))
