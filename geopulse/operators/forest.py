"""Isolation forest: sub-samples chosen by hash in Spark, one task per tree, scored by Arrow batches.

Follows Liu, Ting and Zhou (2008). A tree sees at most ``sample_size`` rows however large the
table is, and the fitted forest holds at most ``n_trees * (2 * sample_size - 1)`` nodes, which
bounds everything that is grouped, collected or shipped to the executors.

Nothing is drawn from a generator: rows, split features and cuts follow from MD5 of seed, tree and node, so any engine that
has the digest can state the same forest. Nodes are numbered like a heap, the children of ``n`` are ``2n + 1`` and ``2n + 2``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geopulse.functions.text import model_version
from geopulse.operators import ranking

NODE_SCHEMA = "tree int, node int, feature int, cut double, below int, above int, size int, depth int"
# Defaults of the fitted model.
TREES = 300
CONTAMINATION = 0.025
SEED = 42
SAMPLE_SIZE = 256
MODEL_KIND = "isolation_forest_fire"


#: Hex digits of a digest that make a number; a prime that rows and trees are mixed by.
DIGITS, PRIME = 12, (1 << 31) - 1
#: Rows that walk all trees at once.
WALK_ROWS = 4096


def number(text: str) -> int:
    """The leading digits of the MD5 of a text as a whole number."""
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def unit(text: str) -> float:
    """A number from 0 to below 1."""
    return number(text) / 16.0**DIGITS


def mixer(seed: int, tree: int) -> tuple[int, int]:
    """Factor and summand of the linear map that gives rows their priority in a tree."""
    return 1 + number(f"{seed}:{tree}:factor") % (PRIME - 1), number(f"{seed}:{tree}:summand") % PRIME


def depth_limit(size: int) -> int:
    return max(1, int(np.ceil(np.log2(max(size, 2)))))


def expected_path(size: np.ndarray) -> np.ndarray:
    """Mean path length of an unsuccessful search among ``size`` rows."""
    n = np.asarray(size, dtype=float)
    deep = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + np.euler_gamma) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


@dataclass(frozen=True)
class Forest:
    """Fitted trees plus what scoring needs to stay comparable with training."""

    nodes: DataFrame
    features: tuple[str, ...]
    sample_size: int
    trees: int
    contamination: float = CONTAMINATION
    seed: int = SEED
    threshold: float | None = None
    lineage: dict = field(default_factory=dict)


def tree_samples(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], rows: int,
    trees: int = TREES, sample_size: int = SAMPLE_SIZE, seed: int = SEED,
) -> DataFrame:
    """Exactly ``min(sample_size, rows)`` rows of each tree, chosen by hash of the row key, whatever the layout.

    Every row has one priority in every tree and the lowest win. A cutoff that leaves about four times the sample
    (never fewer than wanted, but for a chance below 1e-100) keeps the rest of a large table from leaving the scan.
    """
    row_key = F.conv(F.substring(F.md5(F.concat_ws("|", *(F.col(k).cast("string") for k in keys))), 1, DIGITS), 16, 10).cast("long")
    keep = min(1.0, 4.0 * sample_size / max(rows, 1))
    mixers = F.array(*(F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b")) for a, b in (mixer(seed, t) for t in range(trees))))

    def draw(mix: Column, tree: Column) -> Column:
        # A linear map modulo a prime: the products of two numbers below it fit a long.
        return F.struct(tree.cast("int").alias("tree"), ((F.col("_row") % PRIME * mix["a"] + mix["b"]) % PRIME).alias("priority"))

    drawn = F.filter(F.transform(mixers, draw), lambda s: s["priority"] <= F.lit(int(keep * PRIME)))
    candidates = df.select(row_key.alias("_row"), *[F.col(c).cast("double").alias(c) for c in features])
    candidates = candidates.select("_row", *features, F.explode(drawn).alias("s")).select(
        "_row", F.col("s.tree").alias("tree"), F.col("s.priority").alias("priority"), *features
    )
    order = Window.partitionBy("tree").orderBy("priority", "_row", *features)
    return (
        candidates.withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= sample_size)
        .select("tree", "_rank", *features)
    )


def fit_isolation_forest(
    df: DataFrame, features: Sequence[str], keys: Sequence[str], *,
    trees: int = TREES, contamination: float = CONTAMINATION, seed: int = SEED, sample_size: int = SAMPLE_SIZE,
) -> Forest:
    if not features:
        raise ValueError("features must not be empty")
    if not 0.0 < contamination < 0.5:
        raise ValueError(f"contamination must be in (0, 0.5), got {contamination}")
    names = list(features)
    rows = df.count()
    if rows == 0:
        raise ValueError("cannot fit on an empty frame")
    size = min(sample_size, rows)

    def build_tree(pdf: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) != size:
            raise ValueError(f"a tree has {len(pdf)} rows instead of {size}")
        x, tree = pdf.sort_values("_rank")[names].to_numpy(dtype=float), int(pdf["tree"].iloc[0])
        limit = depth_limit(size)
        nodes = []
        pending = [(0, np.arange(len(x)), 0)]
        while pending:
            node, members, depth = pending.pop()
            low, high = x[members].min(axis=0), x[members].max(axis=0)
            splittable = np.flatnonzero(high > low)
            if depth >= limit or len(members) <= 1 or len(splittable) == 0:
                nodes.append((tree, node, -1, 0.0, -1, -1, len(members), depth))
                continue
            feature = int(splittable[int(unit(f"{seed}:{tree}:{node}:feature") * len(splittable))])
            cut = float(low[feature] + unit(f"{seed}:{tree}:{node}:cut") * (high[feature] - low[feature]))
            # Both sides get rows: the least is below every cut, the greatest below none.
            cut = cut if cut > low[feature] else float(high[feature])
            below = x[members, feature] < cut
            nodes.append((tree, node, feature, cut, 2 * node + 1, 2 * node + 2, len(members), depth))
            pending += [(2 * node + 1, members[below], depth + 1), (2 * node + 2, members[~below], depth + 1)]
        return pd.DataFrame(nodes, columns=[part.split()[0] for part in NODE_SCHEMA.split(", ")])

    samples = tree_samples(df, names, keys, rows, trees, size, seed)
    nodes = samples.groupBy("tree").applyInPandas(build_tree, NODE_SCHEMA)
    return Forest(nodes, tuple(names), size, trees, contamination, seed)


def score(df: DataFrame, forest: Forest, out: str = "anomaly_score") -> DataFrame:
    """Score in (0, 1]: higher is stranger. Missing features count as zero."""
    bound = forest.trees * (2 * forest.sample_size - 1)
    table = forest.nodes.limit(bound + 1).toPandas()
    if len(table) > bound:
        raise ValueError(f"forest holds more than the {bound} nodes its size allows")
    # All trees side by side: a row a tree, a place a node of its heap.
    deepest = int(table["depth"].max())
    line = {tree: i for i, tree in enumerate(sorted(table["tree"].unique()))}
    at = table["tree"].map(line).to_numpy(), table["node"].to_numpy()
    feature, cut, length = (np.full((len(line), (2 << deepest) - 1), empty) for empty in (-1, 0.0, 0.0))
    feature[at], cut[at] = table["feature"], table["cut"]
    length[at] = table["depth"] + expected_path(table["size"].to_numpy())
    shared = df.sparkSession.sparkContext.broadcast((feature, cut, length, deepest))
    scale = float(expected_path(np.array([forest.sample_size]))[0]) or 1.0

    @F.pandas_udf("double")
    def path_score(values: pd.DataFrame) -> pd.Series:
        feature, cut, length, deepest = shared.value
        x = values.fillna(0.0).to_numpy(dtype=float)
        out = np.empty(len(x))
        tree = np.arange(len(feature))[None, :]
        for first in range(0, len(x), WALK_ROWS):
            part = x[first : first + WALK_ROWS]
            rows, node = np.arange(len(part))[:, None], np.zeros((len(part), len(feature)), np.int64)
            for _ in range(deepest):
                own = feature[tree, node]
                step = 2 * node + 2 - (part[rows, np.maximum(own, 0)] < cut[tree, node])
                node = np.where(own >= 0, step, node)
            out[first : first + WALK_ROWS] = length[tree, node].sum(axis=1)
        return pd.Series(np.power(2.0, -(out / max(len(feature), 1)) / scale))

    features = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in forest.features])
    return df.withColumn(out, path_score(features))


def flag_top(scored: DataFrame, score_col: str = "anomaly_score", contamination: float = CONTAMINATION) -> DataFrame:
    """Percentile of each score and the flag at the (1 - contamination) quantile of percentiles."""
    ranked = ranking.percentile_rank(scored, score_col, "anomaly_percentile")
    cutoff = ranking.linear_quantiles(ranked, "anomaly_percentile", {"threshold": 1.0 - contamination})
    return ranked.withColumn("threshold", cutoff.select("threshold").scalar()).withColumn(
        "model_is_anomaly", F.col("anomaly_percentile") >= F.col("threshold")
    )


def score_against_training(
    df: DataFrame, forest: Forest, reference: DataFrame, reference_score: str = "anomaly_score"
) -> DataFrame:
    """Scores ranked against the training scores, so a percentile keeps its meaning between batches."""
    if forest.threshold is None:
        raise ValueError("the forest carries no threshold; fit it with train()")
    scored = score(df, forest)
    ranked = ranking.foreign_percentile_rank(reference, reference_score, scored, "anomaly_score", "anomaly_percentile")
    return ranked.withColumn("threshold", F.lit(forest.threshold)).withColumn(
        "model_is_anomaly", F.col("anomaly_percentile") >= F.col("threshold")
    )


def predictions(scored: DataFrame, forest: Forest, revision: str, scored_at: Column, kind: str = "fire") -> DataFrame:
    """Serving columns of scored rows, labelled with a reproducible model version."""
    version = model_version(MODEL_KIND, F.lit(revision), forest.features, forest.trees, forest.seed)
    return scored.select(
        "region_id", "observation_date", version.alias("model_version"),
        "anomaly_score", "anomaly_percentile",
        F.coalesce(F.col("model_is_anomaly"), F.lit(False)).alias("is_anomaly"),
        "threshold", F.lit(revision).alias("dataset_commit"), F.lit(kind).alias("region_kind"),
        scored_at.alias("scored_at"),
    )
