"""Saving and loading the fitted feature pipeline and the three classifiers."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)

# Folder name of each saved model.
FOLDERS = {
    "features": ("feature_pipeline", PipelineModel),
    "lr": ("lr_model", LogisticRegressionModel),
    "rf": ("rf_model", RandomForestClassificationModel),
    "mlp": ("mlp_model", MultilayerPerceptronClassificationModel),
}


def save_models(models: dict, folder: str) -> None:
    """Save any of `features lr rf mlp` under `folder`, replacing earlier ones."""
    for key, model in models.items():
        model.write().overwrite().save(f"{folder}/{FOLDERS[key][0]}")


def load_models(folder: str, keys: tuple[str, ...] = ("features", "lr", "rf", "mlp")) -> dict:
    return {key: FOLDERS[key][1].load(f"{folder}/{FOLDERS[key][0]}") for key in keys}
