"""Explanations of a model's output: Shapley attributions, global importance, local surrogates.

The work is bounded by the sizes asked for (rows explained, background rows, permutations), not by
the table; the table is read for the samples, the means and the quartiles.
"""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.functions.columns import col
from tableloom.functions.keys import hash_key, row_keys, row_name
from tableloom.operators.models import FEATURES, TrainedModel
from tableloom.operators.quantiles import quantiles
from tableloom.operators.split import sample_rows
from tableloom.operators.trees import expected_output, is_tree_model, sums_leaves, tree_attributions, tree_paths
from tableloom.session import local_table, materialize, spread

ALL_SUBSETS_FEATURES = 8
METHODS = ("linear", "tree", "tree_background", "subsets", "kernel", "orders")
#: Coalitions of the kernel method beside two a feature.
COALITIONS = 2_048

# Fixed value: the sentence a feature's direction is reported in.
DIRECTION_TEXT = "Feature '%s' has average SHAP importance of %.4f. On average, this feature %s predictions."


def _vector(features: Sequence[str]) -> Column:
    return F.array(*[col(c).cast("double") for c in features])


def explained_sample(df: DataFrame, keys: Sequence[str], features: Sequence[str], rows: int, seed: int) -> DataFrame:
    """``instance`` (the key as text, or a hash without keys) and the feature values as an array ``x``."""
    sample = sample_rows(df, keys, rows, seed)
    return sample.select(row_name(keys, df.columns).alias("instance"), _vector(features).alias("x")).dropDuplicates(["instance"])


def background_rows(df: DataFrame, keys: Sequence[str], features: Sequence[str], rows: int, seed: int) -> DataFrame:
    """At most ``rows`` rows numbered ``b`` with their values ``z``."""
    named = row_keys(df, keys)
    sample = sample_rows(df, keys, rows, seed + 1).select(hash_key(named, seed + 1).alias("h"), _vector(features).alias("z"))
    return sample.select((F.row_number().over(Window.orderBy("h")) - 1).alias("b"), "z")


def base_value(model: TrainedModel, background: DataFrame) -> DataFrame:
    scored = model.output(background.select(array_to_vector("z").alias(FEATURES)))
    return scored.agg(F.avg("output").alias("base_value"))


def shapley_values(
    model: TrainedModel, df: DataFrame, keys: Sequence[str] = (), rows: int = 100, background: int = 50,
    permutations: int = 10, seed: int = 42, method: str = "auto", coalitions: int | None = None,
) -> DataFrame:
    """Attribution of the output to each feature: instance, feature, feature_value, shapley_value, method.

    ``tree`` is exact for forests and boosting: features outside a subset follow each split by the shares of the
    training rows, and boosted classes are explained by their log-odds. With every other method features outside a
    subset take the values of every background row: ``tree_background`` is the exact sum for trees, ``linear`` the closed form of a
    linear regression, both at any width; ``subsets`` scores all subsets, which is exact and doubles with each feature;
    ``kernel`` fits a weighted linear model to at most ``coalitions`` subsets (all, where there are no more); ``orders`` scores random feature orders and their
    reverses. ``auto`` takes the closed form for a linear regression and the exact sum for trees whose output is the sum of their
    leaves; else subsets for up to ALL_SUBSETS_FEATURES features, and beyond them the kernel (orders for boosted classes,
    whose probability is slow to score). The values of an instance sum to its output less the base value.
    """
    features = model.features
    linear, trees = isinstance(model.model, LinearRegressionModel), is_tree_model(model.model)
    if method == "auto":
        few = len(features) <= ALL_SUBSETS_FEATURES
        if linear or trees and sums_leaves(model.model):
            method = "linear" if linear else "tree_background"
        else:
            method = "subsets" if few else "orders" if trees else "kernel"
    if method not in METHODS or method == "linear" and not linear or method.startswith("tree") and not trees:
        raise ValueError(f"method {method!r} does not fit this model; choose auto, subsets, kernel, orders, linear for a linear regression, or tree or tree_background for trees")
    sample = materialize(explained_sample(df, keys, features, rows, seed))
    if method == "tree":
        return _by_trees(model, sample, features, None, method)
    others = materialize(background_rows(df, keys, features, background, seed))
    if method == "tree_background":
        return _by_trees(model, sample, features, others, method)
    if method == "linear":
        weights = F.array(*[F.lit(float(w)) for w in model.model.coefficients])
        means = others.select(F.posexplode("z").alias("j", "v")).groupBy("j").agg(F.avg("v").alias("mean"))
        entries = sample.select("instance", F.posexplode("x").alias("j", "v")).join(F.broadcast(means), "j")
        values = entries.select("instance", "j", (F.get(weights, F.col("j")) * (F.col("v") - F.col("mean"))).alias("shapley_value"))
        return _named(values, sample, features, method)
    n_background = others.count()
    paired = sample.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_background - 1))))
    paired = spread(paired.join(F.broadcast(others), "b"), "instance", "b")
    if method == "subsets":
        values = _by_subsets(model, paired, len(features))
    elif method == "kernel":
        values = _by_kernel(model, paired, len(features), coalitions or 2 * len(features) + COALITIONS, seed)
    else:
        values = _by_orders(model, paired, len(features), permutations, seed)
    return _named(values, sample, features, method)


def _named(values: DataFrame, sample: DataFrame, features: Sequence[str], method: str) -> DataFrame:
    names = F.array(*[F.lit(f) for f in features])
    return values.join(F.broadcast(sample), "instance").select(
        "instance", F.get(names, F.col("j")).alias("feature"), F.get("x", F.col("j")).alias("feature_value"),
        "shapley_value", F.lit(method).alias("method"),
    )


def explained_position(model: TrainedModel) -> int:
    """The class that is explained: the last of two, else the first."""
    return 1 if model.labels.count == 2 else 0


def _by_trees(model: TrainedModel, sample: DataFrame, features: Sequence[str], others: DataFrame | None, method: str) -> DataFrame:
    """The rows asked for are as many as the caller wanted, and the paths as many as the model's leaves."""
    rows = sample.orderBy("instance").collect()
    paths = tree_paths(sample.sparkSession, model.model, explained_position(model))
    x = np.array([r["x"] for r in rows], float).reshape(-1, len(features))
    z = None if others is None else np.array([r["z"] for r in others.orderBy("b").collect()], float).reshape(-1, len(features))
    # A feature that no path asks about has no part in the sums.
    found = tree_attributions(paths, x, z).select(F.col("i"), "j", F.col("shapley_value").alias("value"))
    instances = local_table(sample.sparkSession, i=pa.array(range(len(rows)), pa.int32()), instance=pa.array([r["instance"] for r in rows], pa.string()))
    cells = instances.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))))
    values = cells.join(found, ["i", "j"], "left").select("instance", "j", F.coalesce("value", F.lit(0.0)).alias("shapley_value"))
    return _named(values, sample, features, method)


def tree_base_value(model: TrainedModel, spark) -> DataFrame:
    """What the values of the ``tree`` method start from: the output when every split goes by its shares."""
    return expected_output(tree_paths(spark, model.model, explained_position(model)))


def _mixed(n: int, takes_x) -> Column:
    """Feature j from ``x`` where ``takes_x(j)`` holds, else from the background row."""
    positions = F.sequence(F.lit(0), F.lit(n - 1))
    return array_to_vector(F.transform(positions, lambda j: F.when(takes_x(j), F.get("x", j)).otherwise(F.get("z", j))))


def _by_subsets(model: TrainedModel, paired: DataFrame, n: int) -> DataFrame:
    subsets = paired.withColumn("subset", F.explode(F.sequence(F.lit(0), F.lit(2**n - 1))))
    vectors = subsets.select("instance", "subset", _mixed(n, lambda j: F.getbit("subset", j) == 1).alias(FEATURES))
    worth = model.output(vectors).groupBy("instance", "subset").agg(F.avg("output").alias("worth"))
    size = F.bit_count("subset")
    joins = [math.factorial(s - 1) * math.factorial(n - s) / math.factorial(n) if s else 0.0 for s in range(n + 1)]
    stays = [math.factorial(s) * math.factorial(n - s - 1) / math.factorial(n) if s < n else 0.0 for s in range(n + 1)]
    gain = F.element_at(F.array(*[F.lit(w) for w in joins]), size + 1)
    loss = F.element_at(F.array(*[F.lit(w) for w in stays]), size + 1)
    per_feature = worth.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    signed = F.when(F.getbit("subset", F.col("j")) == 1, gain).otherwise(-loss) * F.col("worth")
    return per_feature.groupBy("instance", "j").agg(F.sum(signed).alias("shapley_value"))


def coalition_table(n: int, budget: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Subsets of features (rows of 0 and 1) and their kernel weights, neither empty nor whole.

    Sizes are taken from the outside in, each with its complement: whole while the budget lasts, the rest drawn in
    proportion to their weight, which the drawn ones share.
    """
    left = list(range(1, n // 2 + 1))
    masks, weights = [], []
    mass = {s: (n - 1) / (s * (n - s)) * (1 if 2 * s == n else 2) for s in left}
    whole = lambda s: math.comb(n, s) * (1 if 2 * s == n else 2)
    while left and whole(left[0]) <= budget - len(masks):
        s = left.pop(0)
        for members in itertools.combinations(range(n), s):
            mask = np.zeros(n)
            mask[list(members)] = 1
            masks += [mask] if 2 * s == n else [mask, 1 - mask]
        weights += [mass[s] / whole(s)] * whole(s)
    if left and len(masks) < budget:
        draw, counted = np.random.default_rng(seed), {}
        chances = np.array([mass[s] for s in left]) / sum(mass[s] for s in left)
        for _ in range((budget - len(masks)) // 2):
            mask = np.zeros(n)
            mask[draw.permutation(n)[:draw.choice(left, p=chances)]] = 1
            for m in (mask, 1 - mask):
                counted[tuple(m)] = counted.get(tuple(m), 0) + 1
        shared = sum(mass[s] for s in left) / max(1, sum(counted.values()))
        masks += [np.array(m) for m in counted]
        weights += [shared * times for times in counted.values()]
    return np.array(masks).reshape(-1, n), np.array(weights)


def _by_kernel(model: TrainedModel, paired: DataFrame, n: int, budget: int, seed: int) -> DataFrame:
    """Shapley values as the weighted least squares of the coalitions' worths, with their sum held fixed.

    The last feature takes what the others leave. The matrix of the normal equations is the same for all
    instances; Spark sums their right sides.
    """
    spark = paired.sparkSession
    masks, weights = coalition_table(n, budget, seed)
    both = np.vstack([np.zeros(n), np.ones(n), masks])
    table = local_table(
        spark, c=pa.array(range(len(both)), pa.int32()), mask=pa.array(both.tolist(), pa.list_(pa.float64())),
        weight=pa.array([0.0, 0.0, *weights.tolist()]))
    mixed = paired.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(len(both) - 1)))).join(F.broadcast(table), "c")
    vectors = mixed.select("instance", "c", _mixed(n, lambda j: F.get("mask", j) == 1).alias(FEATURES))
    worth = materialize(model.output(vectors).groupBy("instance", "c").agg(F.avg("output").alias("worth")))
    ends = worth.where("c < 2").groupBy("instance").agg(
        F.sum(F.when(F.col("c") == 0, F.col("worth"))).alias("base"), F.sum(F.when(F.col("c") == 1, F.col("worth"))).alias("whole"))
    if n == 1:
        return ends.select("instance", F.lit(0).alias("j"), (F.col("whole") - F.col("base")).alias("shapley_value"))
    reduced = masks[:, :-1] - masks[:, -1:]
    inverse = np.linalg.pinv(reduced.T @ (reduced * weights[:, None]))
    solution = local_table(spark, k=pa.array(range(n - 1), pa.int32()), column=pa.array(inverse.T.tolist(), pa.list_(pa.float64())))
    last = F.element_at("mask", n)
    target = F.col("worth") - F.col("base") - last * (F.col("whole") - F.col("base"))
    sides = (
        worth.where("c > 1").join(F.broadcast(ends), "instance").join(F.broadcast(table), "c")
        .select("instance", (F.col("weight") * target).alias("y"), last.alias("last"), F.posexplode(F.slice("mask", 1, n - 1)).alias("k", "own"))
        .groupBy("instance", "k").agg(F.sum(F.col("y") * (F.col("own") - F.col("last"))).alias("side"))
    )
    first = (
        sides.join(F.broadcast(solution), "k").select("instance", "side", F.posexplode("column").alias("j", "a"))
        .groupBy("instance", "j").agg(F.sum(F.col("side") * F.col("a")).alias("shapley_value"))
    )
    rest = first.groupBy("instance").agg(F.sum("shapley_value").alias("sum")).join(F.broadcast(ends), "instance")
    remaining = rest.select("instance", F.lit(n - 1).alias("j"), (F.col("whole") - F.col("base") - F.col("sum")).alias("shapley_value"))
    return first.unionByName(remaining)


def _by_orders(model: TrainedModel, paired: DataFrame, n: int, permutations: int, seed: int) -> DataFrame:
    chooser = random.Random(seed)
    orders = []
    for _ in range(permutations):
        order = list(range(n))
        chooser.shuffle(order)
        orders += [order, order[::-1]]
    places = [[order.index(j) for j in range(n)] for order in orders]
    integers = pa.list_(pa.int32())
    table = local_table(
        paired.sparkSession, p=pa.array(range(len(orders)), pa.int32()),
        feature_order=pa.array(orders, integers), place=pa.array(places, integers),
    )
    steps = (
        paired.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1))))
        .join(F.broadcast(table), "p")
        .withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n))))
    )
    vectors = steps.select(
        "instance", "p", "step", "feature_order", _mixed(n, lambda j: F.get("place", j) < F.col("step")).alias(FEATURES)
    )
    worth = model.output(vectors).groupBy("instance", "p", "step").agg(
        F.avg("output").alias("worth"), F.first("feature_order").alias("feature_order")
    )
    before = F.lag("worth").over(Window.partitionBy("instance", "p").orderBy("step"))
    gains = worth.withColumn("gain", F.col("worth") - before).where("step > 0")
    return gains.groupBy("instance", F.get("feature_order", F.col("step") - 1).alias("j")).agg(
        F.avg("gain").alias("shapley_value")
    )


def linear_shapley_values(
    df: DataFrame, keys: Sequence[str], coefficients: Mapping[str, float], means: Mapping[str, float],
    rows: int = 100, seed: int = 42,
) -> DataFrame:
    """The closed form for a linear model: coefficient * (value - mean), on sampled rows."""
    entries = [
        F.struct(
            F.lit(f).alias("feature"), col(f).cast("double").alias("feature_value"),
            (F.lit(float(w)) * (col(f) - F.lit(float(means[f])))).alias("shapley_value"),
        )
        for f, w in coefficients.items()
    ]
    sample = sample_rows(df, keys, rows, seed)
    return sample.select(row_name(keys, df.columns).alias("instance"), F.inline(F.array(*entries)))


def feature_means(df: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(features)]).first()
    return {c: row[f"m_{i}"] for i, c in enumerate(features)}


def global_importance(shapley: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature, greatest first."""
    measure = F.avg(F.abs("shapley_value")).alias("importance")
    return shapley.groupBy("feature").agg(measure).orderBy(F.desc("importance"), "feature")


def directions(shapley: DataFrame, top: int = 10) -> DataFrame:
    """The top features with whether they raise or lower the output on average, in words."""
    found = shapley.groupBy("feature").agg(
        F.avg(F.abs("shapley_value")).alias("importance"), F.avg("shapley_value").alias("mean_value")
    )
    verb = F.when(F.col("mean_value") > 0, "increases").otherwise("decreases")
    text = F.format_string(DIRECTION_TEXT, "feature", "importance", verb)
    return found.orderBy(F.desc("importance"), "feature").limit(top).select(
        "feature", "importance", verb.alias("direction"), text.alias("explanation")
    )


def _uniform(seed: int, use: str, j: Column) -> Column:
    """A reproducible number in [0, 1) for feature ``j`` of sample ``s`` around an instance."""
    stamp = F.concat_ws("|", F.lit(str(seed)), F.lit(use), j.cast("string"), F.col("instance"), F.col("s").cast("string"))
    return F.conv(F.substring(F.md5(stamp), 1, 13), 16, 10).cast("double") / float(16**13)


def local_surrogates(
    model: TrainedModel, df: DataFrame, keys: Sequence[str], target: str, instances: int = 5,
    samples: int = 5000, top: int = 10, seed: int = 42, position: int | None = None,
) -> DataFrame:
    """For some rows, a weighted linear model of the output near the row.

    Around each row, feature values are drawn from the quartile bins of the table. The linear model
    says how much it matters that a feature stays in the row's own bin. With more than ``top`` features the
    heaviest of a first fit are fitted again by themselves. For classes
    the output is the probability of the class at ``position`` in sorted order, by default the second.
    """
    if position is None and model.labels.count:
        position = min(1, model.labels.count - 1)
    features = model.features
    n = len(features)
    numbers = df.select(*[col(f).cast("double").alias(f) for f in features])
    cuts = {f: sorted(set(q)) for f, q in quantiles(numbers, features, [0.25, 0.5, 0.75]).items()}
    limits = F.array(*[F.array(*[F.lit(float(c)) for c in cuts[f]]) for f in features])
    cells = numbers.select(F.posexplode(_vector(features)).alias("j", "v"))
    cells = cells.withColumn("bin", _bin_of(F.get(limits, F.col("j")), F.col("v")))
    seen = {
        (r["j"], r["bin"]): r
        for r in cells.groupBy("j", "bin").agg(
            F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.stddev_pop("v").alias("dev"),
            F.min("v").alias("low"), F.max("v").alias("high"),
        ).collect()
    }

    chosen = materialize(sample_rows(df, keys, instances, seed))
    named = chosen.withColumn("_instance", row_name(keys, df.columns))
    scored_rows = model.labels.numbers(model.predict(named, "_predicted"), "_predicted", "_prediction")
    predicted = model.labels.numbers(scored_rows, target, "_actual").select(
        F.col("_instance").alias("instance"), F.col("_prediction").alias("prediction"), F.col("_actual").alias("actual"),
    ).dropDuplicates(["instance"])
    rows = materialize(named.dropDuplicates(["_instance"]).select(
        F.col("_instance").alias("instance"), _vector(features).alias("x"),
        F.transform(_vector(features), lambda v, j: _bin_of(F.get(limits, j), v)).alias("own"),
        F.array(*[_rule(f, col(f).cast("double"), cuts[f]) for f in features]).alias("rules"),
    ))
    bin_table = _bin_table(features, cuts, seen)
    drawn = spread(rows.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(samples - 1)))), "instance", "s")
    positions = F.sequence(F.lit(0), F.lit(n - 1))
    drawn = drawn.withColumn("pick", F.transform(positions, lambda j: _pick(bin_table, j, _uniform(seed, "bin", j))))
    is_row = F.col("s") == 0
    same = F.transform(positions, lambda j: F.when(is_row | (F.get("pick", j) == F.get("own", j)), 1.0).otherwise(0.0))
    values = F.transform(positions, lambda j: F.when(is_row, F.get("x", j)).otherwise(
        _value_in_bin(F.get(F.get(bin_table, j), F.get("pick", j)), _normal(seed, j))))
    vectors = drawn.select("instance", same.alias("same"), array_to_vector(values).alias(FEATURES))
    scored = model.output(vectors, position=position)

    width = 0.75 * math.sqrt(n)

    def slopes_of(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        center, middle = np.average(z, axis=0, weights=weight), np.average(y, weights=weight)
        scaled = (z - center) * weight[:, None]
        return np.linalg.solve(scaled.T @ (z - center) + np.eye(z.shape[1]), scaled.T @ (y - middle))

    def fit(group: pa.Table) -> pa.Table:
        z = group.column("same").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
        y = group.column("output").to_numpy()
        # Distance from the row itself, for which every indicator is 1.
        squared = ((1.0 - z) ** 2).sum(axis=1)
        weight = np.sqrt(np.exp(-squared / width**2))
        slope, chosen_features = slopes_of(z, y, weight), np.arange(n)
        if n > top:
            # The row itself has every indicator at 1, so a slope is its feature's contribution there.
            chosen_features = np.sort(np.argsort(-np.abs(slope), kind="stable")[:top])
            slope = slopes_of(z[:, chosen_features], y, weight)
        instance = group.column("instance")[0].as_py()
        return pa.table({
            "instance": pa.array([instance] * len(slope), pa.string()), "j": pa.array(chosen_features, pa.int32()),
            "contribution": pa.array(slope),
        })

    # Each group is the fixed number of samples of one instance.
    slopes = scored.groupBy("instance").applyInArrow(fit, "instance string, j int, contribution double")
    rank = F.row_number().over(Window.partitionBy("instance").orderBy(F.desc(F.abs("contribution")), "j"))
    names = F.array(*[F.lit(f) for f in features])
    described = rows.select("instance", "rules")
    return (
        slopes.withColumn("rank", rank).where(F.col("rank") <= top)
        .join(F.broadcast(predicted), "instance").join(F.broadcast(described), "instance")
        .select(
            "instance", "prediction", "actual", "rank", F.get(names, F.col("j")).alias("feature"),
            F.get("rules", F.col("j")).alias("rule"), "contribution",
        )
    )


def _bin_of(limits: Column, value: Column) -> Column:
    return F.size(F.filter(limits, lambda c: c < value))


def _bin_table(features: Sequence[str], cuts: Mapping[str, Sequence[float]], seen) -> Column:
    """Per feature, its (at most four) bins with their cumulative share, moments and ends."""
    table = []
    for j, f in enumerate(features):
        bins = [seen.get((j, b)) for b in range(len(cuts[f]) + 1)]
        total = sum(r["n"] for r in bins if r) or 1
        reached, entries = 0, []
        for r in bins:
            reached += r["n"] if r else 0
            moments = [F.lit(float(r[m]) if r else 0.0).alias(m) for m in ("mean", "dev", "low", "high")]
            entries.append(F.struct(F.lit(reached / total).alias("share"), *moments))
        table.append(F.array(*entries))
    return F.array(*table)


def _pick(bin_table: Column, j: Column, u: Column) -> Column:
    """The first bin whose cumulative share passes ``u``: bins in proportion to the table."""
    return F.size(F.filter(F.get(bin_table, j), lambda entry: entry["share"] <= u))


def _normal(seed: int, j: Column) -> Column:
    angle = F.cos(2 * math.pi * _uniform(seed, "a", j))
    return F.sqrt(-2 * F.log(1 - _uniform(seed, "r", j))) * angle


def _value_in_bin(entry: Column, spread: Column) -> Column:
    return F.greatest(entry["low"], F.least(entry["high"], entry["mean"] + entry["dev"] * spread))


def _rule(feature: str, value: Column, cuts: Sequence[float]) -> Column:
    text = F.when(value <= cuts[0], f"{feature} <= {cuts[0]:.2f}")
    for low, high in zip(cuts, cuts[1:]):
        text = text.when(value <= high, f"{low:.2f} < {feature} <= {high:.2f}")
    return text.otherwise(f"{feature} > {cuts[-1]:.2f}")


def top_contributions(local: DataFrame, top: int = 10) -> DataFrame:
    """Per instance, the greatest contributions by size."""
    order = Window.partitionBy("instance").orderBy(F.desc(F.abs("contribution")), "feature")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
