"""The five jobs for spark-submit: prepare, train, score, assign, analyze."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators.assignment import summarize_balance
from holdfast.operators.calibration import METHODS
from holdfast.operators.metrics import OBJECTIVES
from holdfast.operators.models import candidates
from holdfast.plans.experiment import analyze_files, assign_files
from holdfast.plans.prepare import prepare_files
from holdfast.plans.scoring import flagged_count, score_files
from holdfast.plans.training import train
from holdfast.sources.customers import load_customers
from holdfast.sources.sinks import write_table


def _train(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    result = train(
        load_customers(spark, a.input), target=a.target, model=a.model, threshold=a.threshold,
        threshold_metric=a.threshold_metric, fn_fp_ratio=a.fn_fp_ratio, test_size=a.test_size,
        val_size=a.val_size, calibrate=a.calibrate, compare=a.compare_models, tune=a.tune,
        tune_metric=a.tune_metric, tune_trials=a.tune_trials, skip_validation=a.skip_validation,
        bundle_root=a.bundles,
    )
    if a.results:
        write_table(result.results, a.results)
    return result.results


def _prepare(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return prepare_files(spark, a.input, a.cleaned, a.features, a.target).features


def _score(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return flagged_count(
        score_files(spark, a.input, a.output, a.bundles, a.run_id, a.id_column)
    )


def _assign(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    assigned = assign_files(
        spark, a.input, a.output, id_column=a.id_column, probability_column=a.probability_column,
        risk_pool_fraction=a.risk_pool_fraction, treatment_fraction=a.treatment_fraction,
        risk_bands=a.risk_bands, random_state=a.random_state,
    )
    return summarize_balance(assigned, a.probability_column)


def _analyze(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    return analyze_files(
        spark, a.assignments, a.outcomes, a.output, id_column=a.id_column,
        outcome_column=a.outcome_column, alpha=a.alpha, n_permutations=a.permutations,
        random_state=a.random_state,
    ).overall


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="holdfast")
    jobs = top.add_subparsers(dest="job", required=True)

    p = jobs.add_parser("prepare")
    p.add_argument("--input", required=True)
    p.add_argument("--cleaned", required=True)
    p.add_argument("--features", required=True)
    p.add_argument("--target", default="Churn")
    p.set_defaults(run=_prepare)

    p = jobs.add_parser("train")
    p.add_argument("--input", required=True)
    p.add_argument("--bundles", required=True, help="folder for run bundles")
    p.add_argument("--results", help="where to write the results table")
    p.add_argument("--target", default="Churn")
    p.add_argument("--model", default="boosted_balanced", choices=[c.name for c in candidates()])
    p.add_argument("--threshold", type=float, help="fixed threshold instead of a search")
    p.add_argument("--threshold-metric", default="cost", choices=OBJECTIVES)
    p.add_argument("--fn-fp-ratio", type=float, default=10.0)
    p.add_argument("--test-size", type=float, default=0.2)
    p.add_argument("--val-size", type=float, default=0.2)
    p.add_argument("--calibrate", default="isotonic", choices=METHODS)
    p.add_argument("--compare-models", action="store_true")
    p.add_argument("--tune", action="store_true")
    p.add_argument("--tune-metric", default="pr_auc", choices=("pr_auc", "roc_auc"))
    p.add_argument("--tune-trials", type=int, default=20)
    p.add_argument("--skip-validation", action="store_true")
    p.set_defaults(run=_train)

    p = jobs.add_parser("score")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--bundles", required=True)
    p.add_argument("--run-id", help="default: the latest finished run")
    p.add_argument("--id-column", help="default: found by its usual names")
    p.set_defaults(run=_score)

    p = jobs.add_parser("assign")
    p.add_argument("--input", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--id-column", default="CustomerID")
    p.add_argument("--probability-column", default="churn_probability")
    p.add_argument("--risk-pool-fraction", type=float, default=0.30)
    p.add_argument("--treatment-fraction", type=float, default=0.50)
    p.add_argument("--risk-bands", type=int, default=3)
    p.add_argument("--random-state", type=int, default=42)
    p.set_defaults(run=_assign)

    p = jobs.add_parser("analyze")
    p.add_argument("--assignments", required=True)
    p.add_argument("--outcomes", required=True)
    p.add_argument("--output", required=True)
    p.add_argument("--id-column", default="CustomerID")
    p.add_argument("--outcome-column", default="outcome")
    p.add_argument("--alpha", type=float, default=0.05)
    p.add_argument("--permutations", type=int, default=10_000)
    p.add_argument("--random-state", type=int, default=42)
    p.set_defaults(run=_analyze)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    """Run one job in the session spark-submit provides and show its summary."""
    arguments = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"holdfast {arguments.job}").getOrCreate()
    arguments.run(spark, arguments).show(100, truncate=False)


if __name__ == "__main__":
    main()
