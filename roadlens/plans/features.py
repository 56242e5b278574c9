"""The feature table of the severity model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import time_features
from ..functions.fill import fill_const, fill_mean
from ..functions.flags import binarize, flag_to_int
from ..operators.joins import join_counted, join_on_id
from ..schema import MODEL_CATEGORIES, MODEL_FLAGS, MODEL_TWILIGHT, MODEL_WEATHER

HIGH_SEVERITY = 3
UNKNOWN = "Unknown"
COPIES = "copies"
LABEL = "severity_binary"

_ACCIDENT = ["id", "severity", "start_time", "start_lng", "start_lat", "state", "city"]
_ACCIDENT += MODEL_FLAGS + MODEL_TWILIGHT
_WEATHER = ["id", *MODEL_WEATHER, "weather_condition"]


def _named(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).alias(MODEL_WEATHER.get(c, c)) for c in cols])


def joined_inputs(
    accidents: DataFrame, weather: DataFrame, unique_ids: bool = False
) -> DataFrame:
    """Model inputs from the two halves, joined on ``id``: each different joined row once, with
    its number of occurrences in ``copies``. Where no id repeats (de-duplicated silver),
    ``unique_ids`` joins the rows as they are, one exchange per side less, without ``copies``."""
    halves = _named(accidents, _ACCIDENT), _named(weather, _WEATHER)
    return join_on_id(*halves, "id") if unique_ids else join_counted(*halves, "id", COPIES)


def wide_inputs(records: DataFrame) -> DataFrame:
    """Model inputs straight from unsplit silver records: one row per record and no join."""
    return _named(records, _ACCIDENT + _WEATHER[1:])


def engineer(inputs: DataFrame, impute: bool = True) -> DataFrame:
    """Inputs to features: calendar parts, 0/1 flags, filled gaps and the label.

    ``impute`` fills weather readings with their mean over all of ``inputs``. The model does not
    use that: it learns the means from its training rows only.
    """
    weight = COPIES if COPIES in inputs.columns else None
    out = time_features(inputs, "start_time")
    out = flag_to_int(out, MODEL_FLAGS, MODEL_TWILIGHT)
    if impute:
        out = fill_mean(out, list(MODEL_WEATHER.values()), weight=weight)
    out = fill_const(out, {c: UNKNOWN for c in [*MODEL_CATEGORIES, "city"]})
    return out.withColumn(LABEL, binarize(F.col("severity"), HIGH_SEVERITY))


def feature_table(
    accidents: DataFrame, weather: DataFrame, impute: bool = True, unique_ids: bool = False
) -> DataFrame:
    return engineer(joined_inputs(accidents, weather, unique_ids), impute)


def feature_rows(records: DataFrame, impute: bool = True) -> DataFrame:
    return engineer(wide_inputs(records), impute)


def split_train_test(
    df: DataFrame, id_col: str = "id", train_percent: int = 80
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the id: the same split on any cluster and any layout of
    the data, and all rows of an id on one side."""
    marked = with_split(df, id_col, train_percent)
    return tuple(marked.where(F.col("split") == s).drop("split") for s in ("train", "test"))


def with_split(df: DataFrame, id_col: str = "id", train_percent: int = 80) -> DataFrame:
    head = F.substring(F.md5(F.col(id_col).cast("string")), 1, 8)
    bucket = F.conv(head, 16, 10).cast("bigint") % 100
    return df.withColumn("split", F.when(bucket < train_percent, "train").otherwise("test"))
