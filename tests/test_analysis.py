"""Sensitivity, subgradients, fences, ranks, stepwise selection, exact splits, and areas from states."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from labelbench.operators import fences, ranks, roc_state, sensitivity, stepwise, stratify, subgradient
from labelbench.operators.metrics import ranked_roc
from labelbench.shared import cut


def _random_rows(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    label = (x @ [2.0, -1.0, 0.0] + 0.3 * rng.normal(size=n) > 0).astype(float)
    return [(i, *map(float, row), float(y)) for i, (row, y) in enumerate(zip(x, label))]


SCHEMA = "key long, a double, b double, c double, label double"


# --- sensitivity -------------------------------------------------------------------------------


def test_probes_move_one_input_at_a_time(spark):
    df = spark.createDataFrame([(1.0, 10.0, None), (3.0, 20.0, None), (float("nan"), None, None)], "x double, y double, z double")
    rows = sensitivity.probe_rows(df, ["x", "y", "z"], levels=3).collect()
    assert [(r["input"], r["level"], r["x"], r["y"], r["z"]) for r in rows] == [
        ("x", 0, 1.0, 15.0, None),
        ("x", 1, 2.0, 15.0, None),
        ("x", 2, 3.0, 15.0, None),
        ("y", 0, 2.0, 10.0, None),
        ("y", 1, 2.0, 15.0, None),
        ("y", 2, 2.0, 20.0, None),
        ("z", 0, 2.0, 15.0, None),
        ("z", 1, 2.0, 15.0, None),
        ("z", 2, 2.0, 15.0, None),
    ]


def test_ranges_of_a_known_response(spark):
    df = spark.createDataFrame([(0.0, 0.0, 5.0), (4.0, 2.0, 5.0)], "x double, y double, z double")
    probes = sensitivity.probe_rows(df, ["x", "y", "z"], levels=5)
    scored = probes.withColumn("response", F.abs(F.col("x") - 2) + 3 * F.col("y") + F.col("z"))
    found = {r["input"]: r for r in sensitivity.response_ranges(scored, "response").collect()}
    assert [found[i]["range"] for i in "xyz"] == [2.0, 6.0, 0.0]
    assert [found[i]["importance"] for i in "xyz"] == [0.25, 0.75, 0.0]
    assert [found[i]["gradient"] for i in "xyz"] == [1.0, 1.5, 0.0]
    assert found["x"]["variance"] == pytest.approx(np.var([2, 1, 0, 1, 2], ddof=1))
    flat = sensitivity.response_ranges(probes.withColumn("response", F.lit(1)), "response")
    assert {r["importance"] for r in flat.collect()} == {None}


# --- subgradients ------------------------------------------------------------------------------


def _descend_twin(rows, batch_of, loss, iterations, step, penalty, batches, biased):
    x = np.array([r[1:4] for r in rows])
    x = np.hstack([x, np.ones((len(x), 1))]) if biased else x
    y, batch = np.array([r[4] for r in rows]), np.array([batch_of[r[0]] for r in rows])
    w = np.zeros(x.shape[1])
    for t in range(1, iterations + 1):
        own = batch == (t - 1) % batches
        if not own.any():
            continue
        margin = x[own] @ w
        if loss == "hinge":
            side = 2 * y[own] - 1
            factor = np.where(side * margin < 1, -side, 0)
        else:
            factor = np.where(margin - y[own] > 0.2, 1.0, np.where(margin - y[own] < -0.2, -1.0, 0.0))
        size = step / math.sqrt(t)
        w = w * (1 - size * penalty) - size * (factor @ x[own]) / own.sum()
    return w


@pytest.mark.parametrize(("loss", "batches"), [("hinge", 1), ("hinge", 3), ("tube", 2)])
def test_weights_equal_a_numpy_twin(spark, loss, batches):
    rows = _random_rows(400, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    numbers = df.select("key", F.pmod(F.xxhash64("key"), F.lit(batches)).alias("batch")).collect()
    batch_of = {r["key"]: r["batch"] for r in numbers}
    options = dict(iterations=9, step=0.7, penalty=0.05, batches=batches)
    if loss == "hinge":
        model = subgradient.svm(df, ["a", "b", "c"], "key", tolerance=0.0, **options)
    else:
        model = subgradient.support_vector_regression(df, ["a", "b", "c"], "key", width=0.2, tolerance=0.0, **options)
    twin = _descend_twin(rows, batch_of, loss, biased=loss == "tube", **options)
    assert model.weights == pytest.approx(twin.tolist(), abs=1e-9)
    assert model.iterations == 9 and len(model.moves) == 9


def test_it_stops_when_weights_hardly_move(spark):
    df = spark.createDataFrame(_random_rows(200, 2), SCHEMA)
    model = subgradient.svm(df, ["a", "b", "c"], "key", iterations=50, tolerance=0.5)
    assert 1 < model.iterations < 50
    scored = subgradient.classified(df, model, ["a", "b", "c"])
    assert scored.where("prediction != label").count() < 30


def test_rows_with_nulls_are_left_out(spark):
    rows = _random_rows(60, 3)
    odd = [(100, None, 1.0, 1.0, 1.0), (101, 1.0, 1.0, 1.0, None)]
    plain, more = (spark.createDataFrame(r, SCHEMA) for r in (rows, rows + odd))
    found = [subgradient.svm(df, ["a", "b", "c"], "key", iterations=4).weights for df in (plain, more)]
    assert found[0] == pytest.approx(found[1], abs=1e-12)
    model = subgradient.svm(plain.limit(0), ["a", "b", "c"], "key", iterations=2)
    assert model.weights == [0.0, 0.0, 0.0] and model.iterations == 0
    scored = subgradient.classified(more, model, ["a", "b", "c"]).where("key = 100").first()
    assert scored["margin"] is None and scored["prediction"] is None


# --- fences ------------------------------------------------------------------------------------


def test_fences_stand_class_by_class(spark):
    """A value that is ordinary for all rows is far out for its rare class."""
    rng = random.Random(5)
    rows = [(i, "common", rng.uniform(0, 100), 1.0) for i in range(500)]
    rows += [(1000 + i, "rare", rng.uniform(40, 42), float(i)) for i in range(20)]
    rows += [(2000, "rare", 90.0, None), (2001, "common", 900.0, float("nan")), (2002, None, 3.0, 1.0), (2003, None, None, 2.0)]
    df = spark.createDataFrame(rows, "key long, kind string, x double, y double").repartition(4)
    found = fences.outside_fences(df, ["key"], ["x", "y"], "kind").collect()
    assert sorted((r["key"], r["kind"], r["feature"]) for r in found) == [
        (2000, "rare", "x"),
        (2001, "common", "x"),
        (2001, "common", "y"),
    ]
    limits = {(r["kind"], r["feature"]): r for r in fences.quantile_fences(df, ["x", "y"], "kind").collect()}
    values = sorted(r[2] for r in rows if r[1] == "rare")
    assert limits["rare", "x"]["lower_quartile"] == values[math.ceil(0.25 * 21) - 1]
    assert limits["rare", "y"]["n"] == 20 and limits[None, "x"]["n"] == 1


def test_quartiles_are_within_the_stated_rank(spark):
    n, accuracy = 40_000, 100
    df = spark.range(n).select(F.lit("k").alias("kind"), F.shuffle(F.array(F.col("id").cast("double"))).alias("v"))
    df = df.select("kind", F.get("v", F.lit(0)).alias("x")).repartition(6)
    row = fences.quantile_fences(df, ["x"], "kind", accuracy=accuracy).first()
    assert abs(row["lower_quartile"] - 0.25 * n) <= n / accuracy
    assert abs(row["upper_quartile"] - 0.75 * n) <= n / accuracy


# --- ranks -------------------------------------------------------------------------------------


def _middle(values):
    ordered = sorted(values)
    return {v: ordered.index(v) + (ordered.count(v) + 1) / 2 for v in set(values)}


@pytest.mark.parametrize(("partitions", "sent"), [(None, 500_000), (5, 0)])
def test_ranks_with_ties(spark, partitions, sent):
    rng = random.Random(8)
    values = [rng.choice([1.0, 1.0, 1.0, 7.0]) if i % 3 else float(rng.randrange(50)) for i in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(999, None)], "key long, x double")
    wanted = _middle(values)
    ranked = ranks.with_ranks(df.repartition(4), ["x"], partitions, sent).collect()
    assert {r["key"]: r["rank_x"] for r in ranked} == {**{i: wanted[v] for i, v in enumerate(values)}, 999: None}


def test_rank_correlation_is_one_for_any_rising_curve(spark):
    df = spark.range(200).select(
        F.col("id").cast("double").alias("x"), F.exp(F.col("id") / 20).alias("y"), (-F.col("id") ** 3).alias("z")
    )
    df = df.union(spark.sql("SELECT 1.0D, CAST(NULL AS DOUBLE), 2.0D"))
    found = {(r["left"], r["right"]): r["corr"] for r in ranks.rank_correlations(df, ["x", "y", "z"]).collect()}
    assert found == {("x", "y"): pytest.approx(1), ("x", "z"): pytest.approx(-1), ("y", "z"): pytest.approx(-1)}


# --- stepwise ----------------------------------------------------------------------------------


def _refit(x, y, chosen):
    design = np.column_stack([np.ones(len(y)), *[x[:, k] for k in chosen]])
    rest = y - design @ np.linalg.lstsq(design, y, rcond=None)[0]
    return float(rest @ rest)


def test_steps_equal_refitting_each_time(spark):
    """Also with an input that is taken in first and out again, when what it stood for has come in."""
    rng = np.random.default_rng(13)
    n = 300
    a, b, d = rng.normal(size=(3, n))
    both = a + b + 0.3 * rng.normal(size=n)
    x = np.column_stack([a, b, both, d, a * 2])
    y = 1 + 2 * a + 2 * b + 0.4 * rng.normal(size=n)
    names = ["a", "b", "both", "d", "copy"]
    rows = [(*map(float, row), float(t)) for row, t in zip(x, y)]
    df = spark.createDataFrame(rows, [*names, "y"]).repartition(3)
    steps = stepwise.stepwise(df, "y", names)
    chosen = []
    for step in steps:
        k = names.index(step.feature)
        before = _refit(x, y, chosen)
        if step.action == "in":
            left = [c for c in range(5) if c not in chosen and _refit(x, x[:, c], chosen) > 1e-6]
            assert _refit(x, y, [*chosen, k]) == pytest.approx(min(_refit(x, y, [*chosen, c]) for c in left))
            chosen.append(k)
            after = _refit(x, y, chosen)
            f = (before - after) / (after / (n - len(chosen) - 1))
        else:
            chosen.remove(k)
            f = (_refit(x, y, chosen) - before) / (before / (n - len(chosen) - 2))
        assert step.f_value == pytest.approx(f, rel=1e-6)
        assert step.explained == pytest.approx(1 - _refit(x, y, chosen) / _refit(x, y, []))
    kept = {names[k] for k in chosen}
    assert {"b"} < kept and len(kept & {"a", "copy"}) == 1
    assert [s.action for s in steps].count("out") == 1 and "both" not in kept


def test_equal_columns_are_never_both_chosen(spark):
    df = spark.range(100).select(
        F.col("id").cast("double").alias("x"),
        F.col("id").cast("double").alias("same"),
        F.lit(3.0).alias("constant"),
        (F.col("id") * 2.0 + F.col("id") % 7).alias("y"),
    )
    assert [s.feature for s in stepwise.stepwise(df, "y", ["constant", "x", "same"])] == ["x"]
    assert stepwise.stepwise(df.limit(0), "y", ["x"]) == []
    assert stepwise.stepwise(df, "constant", ["x"]) == []
    assert stepwise.stepwise_table(df, "y", ["x"]).columns == ["step", "action", "feature", "f_value", "explained"]


# --- exact splits ------------------------------------------------------------------------------


@pytest.mark.parametrize("percent", [0, 33, 80, 100])
def test_every_class_has_its_share(spark, percent):
    sizes = {"common": 4000, "rare": 7, "one": 1, None: 50}
    rows = [(i * 10 + j, kind) for j, (kind, n) in enumerate(sizes.items()) for i in range(n)]
    df = spark.createDataFrame([*rows, (None, "rare")], "key long, kind string").repartition(6)
    tagged = stratify.tag_class_split(df, "key", "kind", percent).collect()
    counts = Counter((r["kind"], r["split"]) for r in tagged if r["key"] is not None)
    for kind, n in sizes.items():
        assert counts[kind, "train"] == math.floor((n * percent + 50) / 100)
    assert [r["split"] for r in tagged if r["key"] is None] == ["test"]
    again = stratify.tag_class_split(df.coalesce(1), "key", "kind", percent).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, tagged))


def test_equal_keys_stay_together(spark):
    df = spark.createDataFrame([(1, "k")] * 6 + [(2, "k"), (3, "k")], "key long, kind string")
    split = defaultdict(set)
    for r in stratify.tag_class_split(df, "key", "kind", 50).collect():
        split[r["key"]].add(r["split"])
    assert all(len(s) == 1 for s in split.values())
    assert stratify.tag_class_split(df.limit(0), "key", "kind").count() == 0


# --- areas from states -------------------------------------------------------------------------


def test_states_of_parts_add_up_and_the_bound_holds(spark):
    rng = random.Random(4)
    rows = [(i, min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * (i % 2), 0.2))), i % 2) for i in range(2000)]
    rows += [(9001, None, 1), (9002, float("nan"), 0), (9003, 0.5, None)]
    df = cut(spark.createDataFrame(rows, "key long, score double, label int"))
    parts = [roc_state.roc_state(df.where(F.col("key") % 2 == i), "score", bins=64) for i in (0, 1)]
    whole = roc_state.roc_state(df, "score", bins=64)
    both = roc_state.merged(parts)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, whole.collect()))
    assert whole.count() <= 64
    found = roc_state.roc_of_state(both).first()
    exact = ranked_roc(df.where("NOT isnan(score)"), "score").first()
    assert (found["n_pos"], found["n_neg"]) == (exact["n_pos"], exact["n_neg"])
    assert abs(found["roc"] - exact["roc"]) <= found["bound"] < 0.05
    finer = roc_state.roc_of_state(roc_state.roc_state(df, "score", bins=4096)).first()
    assert finer["bound"] < found["bound"] / 10
    curve = roc_state.roc_curve(both).orderBy("bin").collect()
    assert (curve[0]["fall_out"], curve[0]["recall"]) == (1.0, 1.0)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0.5, 1), (2.0, 1), (-1.0, 1)], "score double, label int")
    state = roc_state.roc_state(df, "score", bins=4)
    assert sorted(r["bin"] for r in state.collect()) == [0, 2, 3]
    assert roc_state.roc_of_state(state).first()["roc"] is None
