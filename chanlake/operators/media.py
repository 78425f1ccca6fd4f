"""Detections and media enrichment.

Model calls are injected: the caller passes a loader that builds the model
(once per task, inside the executor) or a plain function. Spark feeds them
Arrow batches through ``mapInPandas`` / ``pandas_udf``; everything around
the call (explode, nest, filter) stays in native expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chanlake.schemas import DETECTION, DETECTIONS  # noqa: F401  (re-exported)


def nest_detections(boxes: DataFrame, image: str = "image_path", order: str = "box_no") -> DataFrame:
    """One record per image with its boxes, ordered by ``order`` then by
    the box values (a total order, so ties come out the same every run)."""
    box = F.struct(F.col(order).alias("_o"), F.col("class"), F.col("confidence").cast("double").alias("confidence"),
                   F.col("bbox"))
    return boxes.groupBy(image).agg(F.array_sort(F.collect_list(box)).alias("_b")).select(
        image, F.transform("_b", lambda b: F.struct(b["class"].alias("class"),
                                                    b["confidence"].alias("confidence"),
                                                    b["bbox"].alias("bbox"))).alias("detections"))


def flatten_detections(nested: DataFrame, image: str = "image_path") -> DataFrame:
    """One row per detection with the four box corners."""
    flat = nested.select(image, F.posexplode("detections").alias("box_no", "d"))
    return flat.select(image, (F.col("box_no") + 1).alias("box_no"), F.col("d.class").alias("class"),
                       F.col("d.confidence").alias("confidence"),
                       *[F.col("d.bbox")[i].alias(n) for i, n in enumerate(("x1", "y1", "x2", "y2"))])


def detect(images: DataFrame, loader: Callable[[], Callable[[list[str]], list[list[dict]]]],
           path: str = "image_path") -> DataFrame:
    """run a detector over a column of image paths.

    ``loader()`` builds the detector once per task; the detector maps a batch of paths to one
    ``[{class, confidence, bbox}]`` per path. Output follows ``DETECTIONS``.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = loader()
        for pdf in batches:
            found = [[dict(d) for d in image] for image in model(pdf[path].tolist())]
            yield pd.DataFrame({"image_path": pdf[path], "detections": found})
    return images.select(F.col(path).alias(path)).mapInPandas(run, DETECTIONS)


def extract_text(images: DataFrame, ocr: Callable[[str], str], path: str = "image_path",
                 out: str = "ocr_text") -> DataFrame:
    """OCR per image path; any error gives NULL for that row only."""
    @F.pandas_udf(T.StringType())
    def run(paths: pd.Series) -> pd.Series:
        def one(p):
            try:
                return ocr(p)
            except Exception:  # noqa: BLE001 - per-row failure is the contract
                return None
        return paths.map(one)
    return images.withColumn(out, run(F.col(path)))
