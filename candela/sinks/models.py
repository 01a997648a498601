"""K4: saving and loading fitted models on the shared file system."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from candela.sinks.writers import _fs


def save_model(model, path: str, metric: float | None = None) -> bool:
    """Writes the model; with a ``metric`` (lower is better) only where it beats the
    one saved there before.  Returns whether it was written."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    path = path.rstrip("/")
    if metric is not None:
        old = saved_metric(spark, path)
        if old is not None and old <= metric:
            return False
    if hasattr(model, "save_to"):
        model.save_to(f"{path}/model")
    else:
        model.write().overwrite().save(f"{path}/model")
    spark.createDataFrame([(json.dumps({"class": type(model).__name__, "metric": metric}),)], "value string") \
        .write.mode("overwrite").text(f"{path}/about")
    return True


def _about(spark: SparkSession, path: str) -> dict | None:
    fs, p = _fs(spark, f"{path.rstrip('/')}/about/_SUCCESS")
    return json.loads(spark.read.text(f"{path.rstrip('/')}/about").first()[0]) if fs.exists(p) else None


def saved_metric(spark: SparkSession, path: str) -> float | None:
    """The metric of the model saved at ``path``, if there is one."""
    return (_about(spark, path) or {}).get("metric")


def load_model(spark: SparkSession, path: str):
    """The model that :func:`save_model` wrote."""
    from pyspark.ml import regression

    from candela.operators.trees import BoostedTrees
    about = _about(spark, path)
    if about is None:
        raise FileNotFoundError(f"no saved model at {path}")
    if about["class"] == BoostedTrees.__name__:
        return BoostedTrees.load_from(spark, f"{path.rstrip('/')}/model")
    return getattr(regression, about["class"]).load(f"{path.rstrip('/')}/model")
