"""Model columns: a predictor loaded once per worker and fed batches."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import functions as F
from pyspark.sql import types as T

EMBEDDING_BATCH = 1024


def batch_predictor(
    make_predict: Callable[[], Callable], return_type: T.DataType, batch_size: int = EMBEDDING_BATCH
):
    """A column function around a model.

    ``make_predict`` runs on the worker, loads the model, and returns a function
    from numpy batches to a numpy batch. Nothing is loaded on the driver.
    """
    return predict_batch_udf(make_predict, return_type=return_type, batch_size=batch_size)


def detector(make_predict: Callable[[], Callable], batch_size: int = 32):
    """Detections (boxes, labels, scores) per image from a pluggable model."""
    detections = T.StructType(
        [
            T.StructField("boxes", T.ArrayType(T.ArrayType(T.FloatType()))),
            T.StructField("labels", T.ArrayType(T.IntegerType())),
            T.StructField("scores", T.ArrayType(T.FloatType())),
        ]
    )

    @F.pandas_udf(detections)
    def detect(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        predict = make_predict()
        for images in batches:
            found = []
            for start in range(0, len(images), batch_size):
                found += predict(list(images.iloc[start : start + batch_size]))
            yield pd.DataFrame(found, columns=["boxes", "labels", "scores"])

    return detect
