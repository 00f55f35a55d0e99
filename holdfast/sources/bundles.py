"""Run bundles: model, calibrator, preprocessing and threshold stored together under one run id."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.calibration import Calibrator
from holdfast.operators.encoding import FeatureSchema
from holdfast.operators.models import ScoringModel

RUNS_SCHEMA = (
    "run_id string, kind string, status string, start_time timestamp, model string, "
    "threshold double, target string, has_record boolean"
)
RECORD_SCHEMA = "run_id string, section string, item string, metric string, number double, text string"


@dataclass(frozen=True)
class RunBundle:
    run_id: str
    model_name: str
    model: ScoringModel
    schema: FeatureSchema
    medians: Mapping[str, float | None]
    threshold: float


def new_run_id() -> str:
    return uuid.uuid4().hex


def save_bundle(spark: SparkSession, root: str, bundle: RunBundle, kind: str = "final",
                record: DataFrame | None = None) -> None:
    """Write the parts and the run's ``record``, then append the row that makes all of them visible at once."""
    base = f"{root.rstrip('/')}/{bundle.run_id}"
    bundle.model.pipeline.write().save(f"{base}/model")
    if bundle.model.calibrator is not None:
        bundle.model.calibrator.save(f"{base}/calibrator")
    state = json.dumps({
        "run_id": bundle.run_id,
        "model_name": bundle.model_name,
        "target": bundle.schema.target,
        "feature_columns": list(bundle.schema.feature_columns),
        "schema": bundle.schema.to_json(),
        "medians": dict(bundle.medians),
        "threshold": bundle.threshold,
        "calibrator": bundle.model.calibrator.method if bundle.model.calibrator else None,
    })
    spark.createDataFrame([(state,)], "value string").coalesce(1).write.text(f"{base}/state")
    if record is not None:
        record.coalesce(1).write.parquet(f"{base}/record")  # numbers of a run, not rows of a table
    started = dt.datetime.now(dt.timezone.utc)
    row = (bundle.run_id, kind, "FINISHED", started, bundle.model_name, bundle.threshold,
           bundle.schema.target, record is not None)
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(
        f"{root.rstrip('/')}/runs"
    )


def runs_table(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(RUNS_SCHEMA).parquet(f"{root.rstrip('/')}/runs")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], RUNS_SCHEMA)
        raise


def load_bundle(spark: SparkSession, root: str, run_id: str | None = None) -> RunBundle:
    """The bundle of the given run, else of the latest finished final run."""
    usable = runs_table(spark, root).filter(
        (F.col("status") == "FINISHED") & (F.col("kind") == "final")
    )
    if run_id is not None:
        usable = usable.filter(F.col("run_id") == run_id)
    found = usable.orderBy(F.desc("start_time"), "run_id").limit(1).collect()
    if not found:
        which = "finished run" if run_id is None else f"finished run '{run_id}'"
        raise LookupError(f"no {which} under {root}; train a model first")
    run_id = found[0]["run_id"]
    base = f"{root.rstrip('/')}/{run_id}"
    state = json.loads(spark.read.text(f"{base}/state").first()["value"])
    calibrator = (
        Calibrator.load(state["calibrator"], f"{base}/calibrator") if state["calibrator"] else None
    )
    return RunBundle(
        run_id=run_id,
        model_name=state["model_name"],
        model=ScoringModel(PipelineModel.load(f"{base}/model"), calibrator),
        schema=FeatureSchema.from_json(state["schema"]),
        medians=state["medians"],
        threshold=state["threshold"],
    )
