import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from labelbench.operators import boosting, pipelines
from labelbench.operators.classifiers import estimator
from labelbench.operators.features import assemble


@pytest.fixture(scope="module")
def rows(spark):
    """Few values, many values, and zeros; the label follows two of them in part."""
    made = spark.range(3000).select(
        F.col("id").alias("key"),
        (F.pmod(F.xxhash64("id"), F.lit(9)) - 4).cast("double").alias("few"),
        F.rand(5).alias("many"),
        F.when(F.rand(6) < 0.7, 0.0).otherwise(F.round(F.rand(7), 2)).alias("zeros"),
    )
    noisy = F.col("few") + 6 * F.col("many") + 3 * F.rand(8)
    made = made.withColumn("label", (noisy > 4.5).cast("double"))
    return assemble(made, ["few", "many", "zeros"]).select("key", "label", "features").cache()


def _scored(model, rows):
    found = model.transform(rows).select("key", "prediction", F.col("probability").cast("string"))
    return {r[0]: (r[1], *map(float, r[2].strip("[]").split(","))) for r in found.collect()}


def test_cells_give_the_trees_of_the_rows(rows):
    boosted = estimator("boosted_trees", seed=11, maxIter=6)
    plain, cells = pipelines.fit(boosted, rows), boosting.fit_boosted(boosted, rows, "key")
    one, two = _scored(plain, rows), _scored(cells, rows)
    assert {k: v[0] for k, v in one.items()} == {k: v[0] for k, v in two.items()}
    assert all(v == pytest.approx(two[k], abs=1e-9) for k, v in one.items())
    assert cells.transform(rows).columns == plain.transform(rows).columns


def test_the_fit_reads_cells_whatever_the_number_of_rows(rows, monkeypatch):
    """Five times the rows are as many cells, of five times the weight."""
    fitted = []
    fit = boosting.fit
    monkeypatch.setattr(boosting, "fit", lambda e, t: fitted.append(t.agg(F.count("*"), F.sum("_rows")).first()) or fit(e, t))
    boosted = estimator("boosted_trees", seed=11, maxIter=1)
    many = rows.withColumn("key", F.explode(F.array(*[F.col("key") + 10_000 * i for i in range(5)])))
    for df in (rows, many):
        boosting.fit_boosted(boosted, df, "key")
    assert fitted[0][1] == 3000 and fitted[1][1] == 15_000
    assert fitted[1][0] <= 9 * 32 * 32 * 2


def test_settings_that_look_at_rows_are_fitted_to_rows(rows):
    for params in ({"subsamplingRate": 0.5}, {"minInstancesPerNode": 5}):
        boosted = estimator("boosted_trees", seed=11, maxIter=2, **params)
        assert not isinstance(boosting.fit_boosted(boosted, rows, "key"), boosting.CellModel)


def test_one_value_and_one_row(spark):
    for n in (1, 5):
        same = spark.createDataFrame([(i, 1.0, Vectors.dense(2.0)) for i in range(n)], ["key", "label", "features"])
        model = boosting.fit_boosted(estimator("boosted_trees", seed=11, maxIter=2), same, "key")
        assert {r["prediction"] for r in model.transform(same).collect()} == {1.0}
