"""Score a feature frame and turn it into predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pipewatch.functions.scalars import suggested_action
from pipewatch.ml.explain import with_top_drivers
from pipewatch.ml.fit import PROB, ModelBundle, probabilities
from pipewatch.plans.rca import with_root_causes
from pipewatch.plans.report import with_risk
from pipewatch.session import durable


def predict(
    bundle: ModelBundle,
    frame: DataFrame,
    logs: DataFrame | None = None,
    runs: DataFrame | None = None,
    high: float = 0.70,
    medium: float = 0.40,
) -> DataFrame:
    """Predictions of a frame: probability, bucket, flag, drivers, action, root causes.

    Scores are made durable before the thresholds look at all of them, so the model
    and the drivers run once.
    """
    bundle.validate()
    scored = with_top_drivers(
        probabilities(bundle, frame), bundle.model, bundle.preprocessor.names_of, width=bundle.preprocessor.size
    ).select("dag_id", "run_id", "logical_date", PROB, "top_drivers")
    risky = with_risk(
        durable(scored),
        PROB,
        high,
        medium,
        bundle.threshold,
    ).withColumn("suggested_action", suggested_action(F.replace("top_drivers", F.lit("|"), F.lit(" "))))
    return with_root_causes(risky, logs, runs).orderBy(F.desc(PROB), "dag_id", "run_id")
