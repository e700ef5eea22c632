"""Tree models on Spark ML: maximum, minimum and condition of future days."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import exp

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.operators.features import feature_names, future_grid, target_names
from skyledger.storage import staged

# Size and shape of the models.
TREES, LEARNING_RATE, DEPTH, SEED = 100, 0.1, 6, 42
#: Classes whose trees grow at the same time.
PARALLEL = 4
#: Bootstrap replicates, and the part of them on either side of an interval.
REPLICATES, TAIL = 400, 0.025


@dataclass
class Models:
    high: PipelineModel
    low: PipelineModel
    condition: PipelineModel | None


def _fit(rows: DataFrame, estimator) -> PipelineModel:
    """Missing features become their training mean, in training and in prediction, so no row is left out.

    A feature without any value is not used.
    """
    known = rows.agg(*[F.count(c).alias(c) for c in feature_names(rows)]).first().asDict()
    features = [c for c, n in known.items() if n]
    filled = [f"_filled_{c}" for c in features]
    stages = [Imputer(inputCols=features, outputCols=filled, strategy="mean"),
              VectorAssembler(inputCols=filled, outputCol="features"), estimator.setFeaturesCol("features")]
    return Pipeline(stages=stages).fit(rows)


def score(model: PipelineModel, rows: DataFrame, output: str) -> DataFrame:
    """``rows`` with the prediction, without the model's working columns."""
    return model.transform(rows).select(*rows.columns, output)


def train_regressor(train: DataFrame, target: str, output: str, trees: int = TREES) -> PipelineModel:
    return _fit(
        train.where(F.col(target).isNotNull()),
        GBTRegressor(labelCol=target, predictionCol=output, maxIter=trees, stepSize=LEARNING_RATE,
                     maxDepth=DEPTH, seed=SEED),
    )


def train_classifier(train: DataFrame, trees: int = TREES) -> PipelineModel | None:
    """Condition model; none where the rows carry no condition codes.

    Boosted trees for several classes: each class gets ``trees`` trees against all others, the class whose trees are
    surest wins. Rows without a code teach nothing.
    """
    if "condition_encoded" not in train.columns:
        return None
    one = GBTClassifier(maxIter=trees, stepSize=LEARNING_RATE, maxDepth=DEPTH, seed=SEED)
    return _fit(
        train.where(F.col("condition_encoded").isNotNull()),
        OneVsRest(classifier=one, labelCol="condition_encoded", predictionCol="_condition_code", parallelism=PARALLEL),
    )


def train_models(train: DataFrame, trees: int = TREES) -> Models:
    high, low = target_names(train)
    return Models(
        train_regressor(train, high, "predicted_max_temp", trees),
        train_regressor(train, low, "predicted_min_temp", trees),
        train_classifier(train, trees),
    )


def predict(models: Models, rows: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Adds the predictions; condition codes are turned back by ``labels(condition, code)``."""
    kept = rows.columns
    scored = score(models.low, score(models.high, rows, "predicted_max_temp"), "predicted_min_temp")
    out = kept + ["predicted_max_temp", "predicted_min_temp"]
    if models.condition is None or labels is None:
        return scored.select(out)
    coded = score(models.condition, scored, "_condition_code").withColumn("_code", F.col("_condition_code").cast("int"))
    names = labels.select(
        F.col("condition").alias("predicted_condition"), F.col("condition_encoded").alias("_code")
    )
    return coded.join(names, "_code", "left").select(*out, "predicted_condition")


def condition_labels(prepared: DataFrame) -> DataFrame:
    return prepared.groupBy("condition_encoded").agg(
        F.min(F.coalesce("condition", F.lit("unknown"))).alias("condition")
    )


def forecast(prepared: DataFrame, train: DataFrame, days: int = 180, place: str | None = None,
             trees: int = TREES, by_place_month: bool = False) -> DataFrame:
    """Predictions for the days after the last observed one; ``by_place_month`` as in ``future_grid``."""
    models = train_models(train, trees)
    labels = condition_labels(prepared) if models.condition is not None else None
    return predict(models, future_grid(prepared, days, place, by_place_month), labels)


def with_seasonal(scored: DataFrame, train: DataFrame) -> DataFrame:
    """Hold-out rows with both temperatures, and the seasonal means ``_high`` and ``_low`` of the training rows.

    The training mean of the same place and month, and the mean over all training rows where that pair is new.
    """
    high, low = target_names(scored)
    seasonal = train.groupBy("city_encoded", "month").agg(
        F.avg(high).alias("_high"), F.avg(low).alias("_low")
    )
    overall = train.agg(F.avg(high).alias("high"), F.avg(low).alias("low"))
    known = scored.where(F.col(high).isNotNull() & F.col(low).isNotNull())
    return known.join(seasonal, ["city_encoded", "month"], "left").withColumns({
        "_high": F.coalesce("_high", overall.select("high").scalar()),
        "_low": F.coalesce("_low", overall.select("low").scalar()),
    })


def holdout_metrics(scored: DataFrame, train: DataFrame) -> DataFrame:
    """Error of the predictions on the hold-out, next to that of a seasonal mean.

    The baseline is that of ``with_seasonal``.
    """
    high, low = target_names(scored)
    both = with_seasonal(scored, train)

    def rmse(a: str, b: str):
        return F.sqrt(F.avg(F.pow(F.col(a) - F.col(b), 2)))

    def mae(a: str, b: str):
        return F.avg(F.abs(F.col(a) - F.col(b)))

    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        rmse("predicted_max_temp", high).alias("rmse_max"),
        mae("predicted_max_temp", high).alias("mae_max"),
        rmse("_high", high).alias("seasonal_rmse_max"),
        rmse("predicted_min_temp", low).alias("rmse_min"),
        mae("predicted_min_temp", low).alias("mae_min"),
        rmse("_low", low).alias("seasonal_rmse_min"),
    )


def poisson_one(draw: Column) -> Column:
    """A Poisson number of mean 1 for a draw from 0 to 1: how many steps of its distribution lie below (at most 16)."""
    steps, mass = [], exp(-1)
    for k in range(16):
        steps.append((steps[-1] if steps else 0.0) + mass)
        mass /= k + 1
    return reduce(lambda a, b: a + b, [F.when(draw >= s, 1).otherwise(0) for s in steps])


def holdout_verdict(scored: DataFrame, train: DataFrame, replicates: int = REPLICATES) -> DataFrame:
    """``holdout_metrics`` with the difference of errors to the seasonal mean, its interval and a verdict, at every size.

    A block bootstrap by day, since rows of a day are alike: each replicate weighs every day by a Poisson number that follows from
    (seed, replicate, day). Squared errors are summed by day first, so replicates multiply days, not rows. ``verdict_``
    is ``better`` or ``worse`` where the interval of the difference (95 %) leaves zero out, else ``open``.
    """
    high, low = target_names(scored)
    pairs = {"max": ("predicted_max_temp", "_high", high), "min": ("predicted_min_temp", "_low", low)}
    both = with_seasonal(scored, train)
    squares = [F.sum(F.pow(F.col(c) - F.col(target), 2)).alias(f"{kind}_{side}")
               for side, (own, mean, target) in pairs.items() for kind, c in (("own", own), ("mean", mean))]
    days = staged(both.groupBy("date").agg(F.count(F.lit(1)).alias("n"), *squares), "errors-per-day")
    drawn = days.withColumn("_replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    draw = F.pmod(F.xxhash64(F.lit(SEED), "_replicate", "date"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    weighed = drawn.withColumn("_w", poisson_one(draw)).groupBy("_replicate").agg(
        F.sum(F.col("_w") * F.col("n")).alias("n"), *[F.sum(F.col("_w") * F.col(f"{k}_{s}")).alias(f"{k}_{s}") for s in pairs for k in ("own", "mean")])
    differ = [(F.sqrt(F.col(f"own_{s}") / F.col("n")) - F.sqrt(F.col(f"mean_{s}") / F.col("n"))).alias(s) for s in pairs]
    bounds = weighed.where("n > 0").select(*differ).agg(*[
        F.percentile(s, F.lit(p)).alias(f"{edge}_{s}") for s in pairs for edge, p in (("low", TAIL), ("high", 1 - TAIL))])
    bounds = staged(bounds, "bounds")
    out = holdout_metrics(scored, train)
    for s in pairs:
        edges = [bounds.select(f"{edge}_{s}").scalar() for edge in ("low", "high")]
        out = out.withColumns({f"difference_{s}": F.col(f"rmse_{s}") - F.col(f"seasonal_rmse_{s}"), f"low_{s}": edges[0], f"high_{s}": edges[1]})
        out = out.withColumn(f"verdict_{s}", F.when(F.col(f"high_{s}") < 0, "better").when(F.col(f"low_{s}") > 0, "worse").when(
            F.col("rows") > 0, "open"))
    return out


def condition_accuracy(coded: DataFrame, train: DataFrame) -> DataFrame:
    """Hold-out rows, the share whose condition is predicted right, and that of the training rows' most frequent condition.

    ``coded`` holds ``condition_encoded`` and ``_condition_code``. Of equally frequent conditions the smallest code counts.
    """
    most = train.groupBy("condition_encoded").count().agg(F.min_by("condition_encoded", F.struct(-F.col("count"), "condition_encoded"))).scalar()
    rows = coded.where(F.col("condition_encoded").isNotNull())
    return rows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.avg((F.col("_condition_code") == F.col("condition_encoded")).cast("double")).alias("accuracy"),
        F.avg((F.col("condition_encoded") == most).cast("double")).alias("most_frequent_accuracy"),
    ).withColumn("beats_most_frequent", F.col("accuracy") > F.col("most_frequent_accuracy"))
