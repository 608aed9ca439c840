"""Whole-volume intensity jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame

from voxelframe.operators import stats


def normalize_layers(vox: DataFrame, cutoff: float = 0.03, scale: str = "gauss", shift: str = "mean",
                     dtype: str = "u8", model_source: DataFrame | None = None) -> DataFrame:
    """Bring every layer of every volume to the scale and shift of its widest layer.

    ``model_source`` may be a coarser pyramid level with the same layers; the
    models are then estimated there and applied to the full volume."""
    source = vox if model_source is None else model_source
    models = stats.layer_models(stats.layer_stats(source, cutoff, dtype), scale, shift)
    return stats.apply_layer_models(vox, models, dtype)
