"""The severity classifier: a Spark ML pipeline over the feature table."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    Imputer,
    OneHotEncoder,
    SQLTransformer,
    StandardScaler,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fill import column_means
from ..schema import (
    MODEL_CALENDAR,
    MODEL_CATEGORIES,
    MODEL_FLAGS,
    MODEL_TWILIGHT,
    MODEL_WEATHER,
)
from ..sources.storage import materialize
from .features import COPIES, LABEL

# Forest settings.
NUM_TREES = 100
MAX_DEPTH = 10
SEED = 42

# Up to here the feature table stays as it was written; a larger one is dealt out evenly over the cluster.
ROWS_AT_ONCE = 100_000

# Stands for "no start time" in hour, weekday and month, which trees can split off.
NO_TIME = -1

READINGS = ["start_lng", "start_lat", *MODEL_WEATHER.values()]
PLAIN = [*READINGS, *MODEL_CALENDAR, *MODEL_FLAGS, *MODEL_TWILIGHT]


def feature_store(features: DataFrame) -> DataFrame:
    """The features written once, for training and scoring to read.

    A forest reads its rows once a level and takes a hundred steps a row, while the files follow the source, of which a few
    row groups may hold everything. So a table of more than ``ROWS_AT_ONCE`` rows is written again, dealt out in
    files of the same size, at least two for each core and none of many more rows than that.
    """
    written = materialize(features, "features")
    n = written.count()
    if n <= ROWS_AT_ONCE:
        return written
    files = max(2 * written.sparkSession.sparkContext.defaultParallelism, n // ROWS_AT_ONCE + 1)
    return materialize(written.repartition(files), "features")


def ready(features: DataFrame) -> DataFrame:
    """Features in the form the pipeline takes: no NULL calendar part (the assembler would fail
    the job on it) and readings as doubles."""
    parts = [c for c in MODEL_CALENDAR if c in ("hour", "day_of_week", "month")]
    out = {c: F.coalesce(F.col(c), F.lit(NO_TIME)) for c in parts}
    out |= {c: F.col(c).cast("double") for c in READINGS}
    return features.withColumns(out)


def index_categories() -> StringIndexer:
    """Most frequent value is 0; a value not seen in training gets one extra index."""
    return StringIndexer(
        inputCols=MODEL_CATEGORIES,
        outputCols=[f"{c}_indexed" for c in MODEL_CATEGORIES],
        handleInvalid="keep",
    )


def weighted_index(rows: DataFrame) -> list[StringIndexerModel]:
    """:func:`index_categories` where a row counts as many times as it has copies; ties in name order.

    The different values of each category reach the driver, as they do in any such index.
    """
    out = []
    for name in MODEL_CATEGORIES:
        counted = rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.sum(COPIES).alias("n"))
        labels = [r[0] for r in counted.orderBy(F.desc("n"), name).collect()]
        out.append(StringIndexerModel.from_labels(labels, name, f"{name}_indexed", handleInvalid="keep"))
    return out


def weighted_means(rows: DataFrame) -> SQLTransformer:
    """Fills readings with means in which a row counts as many times as it has copies."""
    means = column_means(rows, READINGS, COPIES).first()
    filled = ", ".join(
        f"coalesce(nanvl(`{c}`, null), {float(means[c] if means[c] is not None else 0.0)!r}D) AS `{c}_filled`"
        for c in READINGS
    )
    return SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__")


def one_hot() -> OneHotEncoder:
    return OneHotEncoder(
        inputCols=[f"{c}_indexed" for c in MODEL_CATEGORIES],
        outputCols=[f"{c}_encoded" for c in MODEL_CATEGORIES],
    )


def severity_pipeline(
    num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, seed: int = SEED, weighted: bool = False
) -> Pipeline:
    """Indexing, encoding, mean imputation, assembly, scaling, forest.

    Both categories are indexed and encoded by one stage each, and all means come from one
    aggregate over the training rows.
    """
    imputer = Imputer(inputCols=READINGS, outputCols=[f"{c}_filled" for c in READINGS], strategy="mean")
    inputs = imputer.getOutputCols() + [c for c in PLAIN if c not in READINGS]
    inputs += [f"{c}_encoded" for c in MODEL_CATEGORIES]
    forest = RandomForestClassifier(
        featuresCol="scaled_features",
        labelCol=LABEL,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        # the same trees; without it each level sends every row through all trees from their roots
        cacheNodeIds=True,
    )
    if weighted:
        forest.setWeightCol(COPIES)
    return Pipeline(
        stages=[
            index_categories(),
            one_hot(),
            imputer,
            VectorAssembler(inputCols=inputs, outputCol="features"),
            StandardScaler(inputCol="features", outputCol="scaled_features"),
            forest,
        ]
    )


def train_classifier(train: DataFrame, **settings) -> PipelineModel:
    """Fit on labelled rows. Hand in a written table (:func:`feature_store`): fitting reads it several times.

    Where rows stand for several, index, means and forest weigh them. The scaler only divides each
    slot by a constant, which leaves every split of a tree where it is.
    """
    rows = ready(train.where(F.col("severity").isNotNull()))
    return _pipeline_for(rows, **settings).fit(rows)


def _pipeline_for(rows: DataFrame, **settings) -> Pipeline:
    if COPIES not in rows.columns:
        return severity_pipeline(**settings)
    pipeline = severity_pipeline(weighted=True, **settings)
    _, encoder, _, *rest = pipeline.getStages()
    return Pipeline(stages=[*weighted_index(rows), encoder, weighted_means(rows), *rest])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``prediction`` and ``probability`` beside the features; works on streams too."""
    return model.transform(ready(features))


def confusion_matrix(predictions: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per label and prediction. A row that stands for several counts as many, and rows
    without a severity, whose label is only a default, do not count."""
    if "severity" in predictions.columns:
        predictions = predictions.where(F.col("severity").isNotNull())
    n = F.sum(F.col(COPIES).cast("bigint")) if COPIES in predictions.columns else F.count(F.lit(1))
    return predictions.groupBy(
        F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")
    ).agg(n.alias("n"))


def evaluate(matrix: DataFrame) -> DataFrame:
    """``accuracy`` and class-weighted ``f1`` from a confusion matrix, so that the predictions
    are scored once for all measures."""
    def role(col: str, actual: bool):
        return F.struct(F.col(col).alias("class"), F.lit(actual).alias("actual"))

    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    per_class = (
        matrix.select("n", hit.alias("hit"), F.inline(F.array(role("label", True), role("prediction", False))))
        .groupBy("class")
        .agg(
            F.sum(F.when(F.col("actual"), F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(~F.col("actual"), F.col("n")).otherwise(0)).alias("predicted"),
            F.sum(F.when(F.col("actual"), F.col("hit")).otherwise(0)).alias("hit"),
        )
    )
    # F1 of a class is 2 * hits / (rows of the class + rows predicted as the class).
    f1 = F.try_divide(2.0 * F.col("hit"), F.col("support") + F.col("predicted"))
    return per_class.agg(
        F.sum("support").alias("n"),
        F.try_divide(F.sum("hit"), F.sum("support")).alias("accuracy"),
        F.try_divide(F.sum(F.coalesce(f1, F.lit(0.0)) * F.col("support")), F.sum("support")).alias("f1"),
    )


def top_predictions(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` rows most surely of the high class; ties in id order."""
    probability = F.get(F.col("_p"), F.lit(1)).alias("probability_high")
    return (
        predictions.withColumn("_p", vector_to_array("probability"))
        .select("id", "severity", LABEL, "prediction", probability)
        .orderBy(F.desc("prediction"), F.desc("probability_high"), "id")
        .limit(n)
    )


def feature_names(predictions: DataFrame) -> list[str]:
    """Names of the slots of the ``features`` vector, from its column metadata."""
    groups = predictions.schema["features"].metadata["ml_attr"]["attrs"]
    slots = sorted((a["idx"], a["name"]) for attrs in groups.values() for a in attrs)
    return [name for _, name in slots]


def feature_importance(model: PipelineModel, predictions: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most important features by name."""
    scores = zip(feature_names(predictions), model.stages[-1].featureImportances.toArray())
    rows = [(name, float(value)) for name, value in scores]
    return (
        predictions.sparkSession.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), "feature")
        .limit(k)
    )


def tune(
    train: DataFrame, num_trees: list[int], max_depth: list[int], folds: int = 3, parallelism: int = 2
) -> CrossValidatorModel:
    """Cross-validated choice of forest size, by class-weighted F1.

    Folds follow a hash of the id, so the copies of a record never sit on both sides.
    """
    rows = ready(train.where(F.col("severity").isNotNull())).withColumn(
        "fold", F.pmod(F.hash("id"), F.lit(folds)).cast("int")
    )
    pipeline = _pipeline_for(rows)
    forest = pipeline.getStages()[-1]
    grid = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, num_trees)
        .addGrid(forest.maxDepth, max_depth)
        .build()
    )
    evaluator = MulticlassClassificationEvaluator(labelCol=LABEL, metricName="f1")
    if COPIES in rows.columns:
        evaluator.setWeightCol(COPIES)
    return CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=grid,
        evaluator=evaluator,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    ).fit(rows)
