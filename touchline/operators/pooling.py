"""Logistic pooling: combine forecasts in log-odds with a multinomial regression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import SUFFIXES, log_odds, spread, triple
from touchline.operators.relational import played

SOURCES = ("calibrated", "elo")
# Class order, the sorted labels.
CLASS_INDEX = {"1": 0.0, "2": 1.0, "X": 2.0}
SUFFIX_CLASS = {"1": 0, "2": 1, "x": 2}
TOLERANCE = 1e-8


@dataclass(frozen=True)
class Pool:
    """A fitted pool and what is needed to apply and describe it."""

    model: LogisticRegressionModel
    sources: tuple[str, ...]
    interaction: bool
    feature_sd: tuple[float, ...]
    rows: int


def pool_features(sources: tuple[str, ...], interaction: bool = False) -> dict[str, Column]:
    """Named feature columns: three log-odds per source and, with ``interaction``, those of
    the second source scaled by how undecided the first is."""
    features = {
        f"logit_{source}_{suffix}": log_odds(F.col(f"{source}_{suffix}"))
        for source in sources
        for suffix in SUFFIXES
    }
    if interaction and len(sources) > 1:
        undecided = spread([F.col(name) for name in triple(sources[0])])
        features |= {
            f"interaction_{suffix}": log_odds(F.col(f"{sources[1]}_{suffix}")) * undecided
            for suffix in SUFFIXES
        }
    return features


def _assembler(names: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")


def fit_pool(train: DataFrame, sources: tuple[str, ...] = SOURCES, interaction: bool = False) -> Pool:
    """Fit on the training half only. The rows are read three times, then held by the fit.

    Spark minimises the mean loss plus a penalty; a weight of one over the number of rows
    makes that the sum of losses plus half the squared coefficients.
    """
    features = pool_features(sources, interaction)
    names = list(features)
    label = F.when(F.col("result") == "1", CLASS_INDEX["1"])
    label = label.when(F.col("result") == "2", CLASS_INDEX["2"])
    label = label.when(F.col("result") == "X", CLASS_INDEX["X"])
    inputs = [name for source in sources for name in triple(source)]
    rows = (
        played(train)
        .dropna(subset=inputs)
        .select(label.alias("label"), *[v.alias(k) for k, v in features.items()])
    )
    stats = rows.agg(
        F.count("*").alias("rows"), *[F.stddev_pop(n).alias(n) for n in names]
    ).first()
    if not stats["rows"]:
        raise ValueError("no played match has all forecasts")
    estimator = LogisticRegression(
        family="multinomial",
        regParam=1.0 / stats["rows"],
        elasticNetParam=0.0,
        standardization=False,
        maxIter=1000,
        tol=TOLERANCE,
    )
    model = estimator.fit(_assembler(names).transform(rows).select("label", "features"))
    return Pool(model, tuple(sources), interaction, tuple(stats[n] for n in names), stats["rows"])


def apply_pool(df: DataFrame, pool: Pool, prefix: str = "pooled") -> DataFrame:
    """Add the pooled triple to the played matches; unplayed ones are dropped.

    A match lacking a forecast gets NULLs, a class absent from training probability 0.
    """
    features = pool_features(pool.sources, pool.interaction)
    complete = F.lit(True)
    for source in pool.sources:
        for name in triple(source):
            complete = complete & F.col(name).isNotNull()
    scored = pool.model.transform(
        _assembler(list(features)).transform(played(df).withColumns(features))
    ).withColumn("__p", vector_to_array("probability"))
    columns = {
        f"{prefix}_{s}": F.when(complete, F.coalesce(F.get("__p", F.lit(i)), F.lit(0.0)))
        for s, i in SUFFIX_CLASS.items()
    }
    kept = [c for c in df.columns if c not in columns]
    return scored.select(*kept, *[columns[name].alias(name) for name in triple(prefix)])


def pool_table(spark: SparkSession, pool: Pool) -> DataFrame:
    """The fitted coefficients as ``(class, feature, coefficient)`` rows."""
    names = list(pool_features(pool.sources, pool.interaction))
    matrix, intercepts = pool.model.coefficientMatrix.toArray(), pool.model.interceptVector
    rows = []
    for label, index in CLASS_INDEX.items():
        i = int(index)
        if i < len(intercepts):
            rows.append((label, "intercept", float(intercepts[i])))
            rows += [(label, n, float(v)) for n, v in zip(names, matrix[i], strict=True)]
    return spark.createDataFrame(rows, "class string, feature string, coefficient double")


def pool_coefficients(spark: SparkSession, pool: Pool) -> DataFrame:
    """Mean absolute coefficient per source, per standard deviation of the feature."""
    matrix = abs(pool.model.coefficientMatrix.toArray()).mean(axis=0) * pool.feature_sd
    sources = [*pool.sources, *(["interaction"] if pool.interaction else [])]
    width = len(SUFFIXES)
    rows = [
        (source, float(matrix[i * width : (i + 1) * width].mean()))
        for i, source in enumerate(sources)
    ]
    return spark.createDataFrame(rows, "source string, influence double")
