"""The experiment jobs on stored tables: assign, and later analyze."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.assignment import assign_experiment, assignment_record
from holdfast.operators.itt import IttReport, analyze_experiment
from holdfast.session import stage_table
from holdfast.sources.customers import load_customers
from holdfast.sources.fingerprints import table_fingerprint
from holdfast.sources.sinks import write_json_record, write_table


def assign_files(
    spark: SparkSession,
    scored_path: str,
    output_path: str,
    *,
    id_column: str = "CustomerID",
    probability_column: str = "churn_probability",
    risk_pool_fraction: float = 0.30,
    treatment_fraction: float = 0.50,
    risk_bands: int = 3,
    random_state: int = 42,
) -> DataFrame:
    """Write the assignments and, beside them, an audit record; returns the stored assignments."""
    scored = load_customers(spark, scored_path)
    assigned = assign_experiment(
        scored, id_column=id_column, probability_column=probability_column,
        risk_pool_fraction=risk_pool_fraction, treatment_fraction=treatment_fraction,
        n_risk_bands=risk_bands, random_state=random_state,
    )
    write_table(assigned, output_path)
    stored = load_customers(spark, output_path)
    record = assignment_record(stored, table_fingerprint(scored), {
        "input_path": scored_path, "output_path": output_path, "id_column": id_column,
        "probability_column": probability_column, "risk_pool_fraction": risk_pool_fraction,
        "treatment_fraction": treatment_fraction, "risk_bands": risk_bands,
        "random_state": random_state,
    })
    write_json_record(record, f"{output_path.rstrip('/')}_metadata")
    return stored


def analysis_record(
    report: IttReport, assignments: DataFrame, outcomes: DataFrame, outcome_column: str,
    random_state: int,
) -> DataFrame:
    """One nested row: overall effect, effects by band, and the fingerprints of both inputs."""
    bands = report.by_band.agg(
        F.array_sort(F.collect_list(F.struct(*report.by_band.columns))).alias("by_band")
    )
    prints = {
        name: table_fingerprint(df).select(F.struct("n_rows", "digest")).scalar()
        for name, df in (("assignments", assignments), ("outcomes", outcomes))
    }
    return report.overall.select(
        F.struct(*report.overall.columns).alias("overall"),
        bands.scalar().alias("by_band"),
        F.struct(
            F.current_timestamp().alias("created"),
            prints["assignments"].alias("assignments"), prints["outcomes"].alias("outcomes"),
            F.lit(outcome_column).alias("outcome_column"),
            F.lit(random_state).alias("random_state"),
        ).alias("metadata"),
    )


def analyze_files(
    spark: SparkSession,
    assignments_path: str,
    outcomes_path: str,
    output_path: str,
    *,
    id_column: str = "CustomerID",
    outcome_column: str = "outcome",
    alpha: float = 0.05,
    n_permutations: int = 10_000,
    random_state: int = 42,
) -> IttReport:
    """Analyze stored assignments and outcomes and write the report as JSON."""
    assignments = load_customers(spark, assignments_path)
    outcomes = load_customers(spark, outcomes_path)
    report = analyze_experiment(
        assignments, outcomes, id_column=id_column, outcome_column=outcome_column, alpha=alpha,
        n_permutations=n_permutations, random_state=random_state,
    )
    record = analysis_record(report, assignments, outcomes, outcome_column, random_state)
    write_json_record(record, output_path)
    return report
