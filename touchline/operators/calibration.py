"""Isotonic calibration: one non-decreasing curve per outcome."""

from __future__ import annotations

from collections.abc import Mapping
from functools import partial

from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import LABELS, OUTCOMES, occurred, outcome_signal, triple
from touchline.operators.parallel import together
from touchline.operators.relational import long_outcomes, long_signals, normalised

Curves = Mapping[str, IsotonicRegressionModel]


def outcome_rates(long: DataFrame) -> DataFrame:
    """The share of hits and the number of rows at every distinct forecast.

    The curve fitted to these weighted points equals the one fitted to the rows, and the
    shuffle carries one partial row per distinct forecast and map task.
    """
    return (
        long.filter(F.col("predicted_prob").isNotNull() & F.col("actual_occurred").isNotNull())
        .groupBy("outcome", "predicted_prob")
        .agg(
            F.avg(F.col("actual_occurred").cast("double")).alias("label"),
            F.count("*").cast("double").alias("weight"),
        )
    )


def fit_curves(long: DataFrame) -> dict[str, IsotonicRegressionModel]:
    """Fit the curve of every outcome. Spark pools adjacent violators within range
    partitions; only the pooled blocks, which are the curve, meet on the driver."""
    rates = outcome_rates(long).persist()
    estimator = IsotonicRegression(
        featuresCol="predicted_prob", labelCol="label", weightCol="weight", isotonic=True
    )

    def fit(label: str) -> IsotonicRegressionModel:
        return estimator.fit(rates.filter(F.col("outcome") == label))

    try:
        models = together(rates.sparkSession, *[partial(fit, label) for label in LABELS])
        return dict(zip(LABELS, models, strict=True))
    finally:
        rates.unpersist()


def fit_crowd_curves(matches: DataFrame, prefix: str = "crowd") -> dict[str, IsotonicRegressionModel]:
    return fit_curves(long_outcomes(matches, prefix, ids=("result",)))


def fit_rating_curves(matches: DataFrame) -> dict[str, IsotonicRegressionModel]:
    return fit_curves(long_signals(matches))


def curve_table(spark: SparkSession, curves: Curves) -> DataFrame:
    """The curves as rows: straight lines between boundaries, flat outside them."""
    rows = [
        (label, boundary, value)
        for label, model in curves.items()
        for boundary, value in zip(model.boundaries, model.predictions, strict=True)
    ]
    rows = [(label, float(boundary), float(value)) for label, boundary, value in rows]
    return spark.createDataFrame(rows, "outcome string, boundary double, value double")


def _apply(df: DataFrame, curves: Curves, signals: Mapping[str, Column], prefix: str) -> DataFrame:
    kept = [c for c in df.columns if c not in triple(prefix)]
    out = df.select(*kept, *[signals[label].alias(f"__{label}") for label in LABELS])
    for suffix, label in OUTCOMES.items():
        model = curves[label].copy()
        model.setFeaturesCol(f"__{label}").setPredictionCol(f"{prefix}_{suffix}")
        out = model.transform(out)
    return normalised(out.drop(*[f"__{label}" for label in LABELS]), prefix)


def calibrate(
    df: DataFrame, curves: Curves, source: str = "crowd", prefix: str = "calibrated"
) -> DataFrame:
    """Add the calibrated triple, played or not. It stays on the JVM: no Python per row."""
    return _apply(df, curves, {v: F.col(f"{source}_{k}") for k, v in OUTCOMES.items()}, prefix)


def rating_probabilities(
    df: DataFrame, curves: Curves, expected: str = "elo_expected_score", prefix: str = "elo"
) -> DataFrame:
    """Turn the expected score into three probabilities."""
    return _apply(df, curves, {v: outcome_signal(v, F.col(expected)) for v in LABELS}, prefix)


def calibration_metrics(
    df: DataFrame, raw: str = "crowd", fitted: str = "calibrated", run: str | None = None
) -> DataFrame:
    """Brier scores before and after, per outcome and pooled, as ``(metric, value)`` rows,
    marked with ``run`` if one is named, so that the rows of several runs can be appended.

    In-sample if the curves were fitted on the same rows. One pass gives all of them.
    """
    parts, metrics = [], []
    for kind, prefix in (("raw", raw), ("calibrated", fitted)):
        for suffix, label in OUTCOMES.items():
            error = F.pow(F.col(f"{prefix}_{suffix}") - occurred(label), 2)
            parts.append(F.avg(error).alias(f"brier_{kind}_{label}"))
            metrics.append((f"brier_{kind}_{label}", F.col(f"brier_{kind}_{label}")))
        names = [f"brier_{kind}_{label}" for label in LABELS]
        pooled = (F.col(names[0]) + F.col(names[1]) + F.col(names[2])) / F.lit(3.0)
        metrics.append((f"brier_{kind}_pooled", pooled))
    parts.append(F.count("*").alias("rows"))
    metrics.append(("rows", F.col("rows").cast("double")))
    rows = [F.struct(F.lit(n).alias("metric"), v.alias("value")) for n, v in metrics]
    named = [] if run is None else [F.lit(run).alias("run")]
    return df.agg(*parts).select(*named, F.inline(F.array(*rows)))
