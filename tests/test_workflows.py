import random

import pytest

from labelbench.plans.workflows import classify_lines, classify_table
from labelbench.sources import FEATURES


@pytest.fixture(scope="module")
def lines():
    """Made-up samples: more alcohol and less acidity mean better quality."""
    rng = random.Random(4)
    rows = []
    for _ in range(600):
        quality = rng.choice([4, 5, 5, 6, 6, 6, 7])
        values = [round(rng.uniform(0.5, 3), 3) for _ in FEATURES]
        values[1] = round(max(0.05, 2.2 - 0.3 * quality + rng.gauss(0, 0.1)), 3)
        values[-1] = round(6 + quality * 0.8 + rng.gauss(0, 0.4), 2)
        rows.append(";".join(map(str, [*values, quality])))
    return rows


def test_every_model_is_reported_on_lines(spark, tmp_path, lines):
    path = tmp_path / "samples.data"
    path.write_text("\n".join(lines))
    run = classify_lines(spark, str(path), trees=(3, 5), depths=(2, 12), seed=11)
    counts = {r["split"]: r["n"] for r in run.counts.collect()}
    assert sum(counts.values()) == len(lines)
    assert [len(r["features"]) for r in run.preview.collect()] == [11, 11, 11]
    reports = {r["model"]: r for r in run.reports.collect()}
    assert len(reports) == 6 + 4
    for name, row in reports.items():
        assert row["n"] == counts["test"]
        majority = min(row["n_pos"], row["n_neg"]) / row["n"]
        if name not in ("naive_bayes", "linear_svm", "logistic_regression"):
            assert row["test_error"] < majority / 2, name


def test_pipeline_and_search_on_a_headed_table(spark, tmp_path, lines):
    path = tmp_path / "samples.csv"
    path.write_text("\n".join([";".join(FEATURES + ["quality"]), *lines]))
    run = classify_table(spark, str(path), trees=(3, 5), depths=(2, 4), seed=11)
    counts = {r["split"]: r["n"] for r in run.counts.collect()}
    assert sum(counts.values()) == len(lines)
    assert run.preview.columns == FEATURES + ["quality", "good"]
    rows = run.reports.collect()
    assert [r["model"].split(",")[0] for r in rows] == ["forest pipeline", "cross-validated"]
    for row in rows:
        assert row["n"] == counts["test"]
        assert row["test_error"] < min(row["n_pos"], row["n_neg"]) / row["n"] / 2
