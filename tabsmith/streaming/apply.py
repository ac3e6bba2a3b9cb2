"""A fitted recipe is a set of projections, two row filters and joins with static label
mappings, all of which Structured Streaming runs per micro-batch without state. So new
rows arriving as a stream are cleaned and scored with the same fitted numbers as the
batch table; nothing is refitted on the stream.

    clean = transform_stream(recipe, spark.readStream.schema(raw.schema).parquet(path))
    scored = score_stream(recipe, trained, stream)
    scored.writeStream.format("parquet").option("checkpointLocation", ckpt).start(out)
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabsmith.operators import models
from tabsmith.plans.recipe import Recipe


def transform_stream(recipe: Recipe, stream: DataFrame) -> DataFrame:
    """Phases 2-8 on a streaming frame (stream-static joins for label codes)."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame; use Recipe.transform for tables")
    return recipe.transform(stream)


def score_stream(recipe: Recipe, trained: models.TrainedModels, stream: DataFrame) -> DataFrame:
    """Clean, predict every target and clip regression predictions, per micro-batch."""
    return models.predict(trained, transform_stream(recipe, stream))
