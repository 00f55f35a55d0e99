from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from holdfast import jobs
from holdfast.sources.sinks import write_table


def test_jobs_from_raw_table_to_report(spark, customers, tmp_path, capsys):
    raw, folder = str(tmp_path / "raw.csv"), str(tmp_path)
    write_table(customers, raw)
    jobs.main(["prepare", "--input", raw, "--cleaned", f"{folder}/cleaned",
               "--features", f"{folder}/features"])
    jobs.main(["train", "--input", raw, "--bundles", f"{folder}/bundles", "--model",
               "random_forest", "--skip-validation", "--calibrate", "sigmoid", "--results",
               f"{folder}/results"])
    jobs.main(["score", "--input", raw, "--output", f"{folder}/scores",
               "--bundles", f"{folder}/bundles"])
    jobs.main(["assign", "--input", f"{folder}/scores", "--output", f"{folder}/assigned"])
    outcomes = customers.select("CustomerID", F.col("Churn").alias("outcome"))
    write_table(outcomes, f"{folder}/outcomes")
    jobs.main(["analyze", "--assignments", f"{folder}/assigned", "--outcomes",
               f"{folder}/outcomes", "--output", f"{folder}/report", "--permutations", "100"])
    shown = capsys.readouterr().out
    assert "n_flagged" in shown and "risk_band_1_highest" in shown and "ci_low" in shown
    assert spark.read.parquet(f"{folder}/assigned").count() == 54


def test_unknown_choices_are_refused():
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["train", "--input", "x", "--bundles", "y", "--model", "nope"])
