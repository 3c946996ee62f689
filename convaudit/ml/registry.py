"""Versioned model storage.

The reference moves the previous model file aside with a timestamp suffix and
writes the new one. Here every save is a new immutable version directory
``<root>/<name>/<version>`` (older versions are the backups), and a small
parquet table ``<root>/_registry`` lists (name, version, path, created_at,
metrics). ``latest`` is the greatest version of a name. Works on any Hadoop
file system path the cluster shares.
"""

from __future__ import annotations

import datetime as _dt
import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

REGISTRY = "_registry"


def _now_version() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d-%H%M%S")


def save_model(spark: SparkSession, model: PipelineModel, root: str, name: str,
               metrics: dict | None = None, version: str | None = None) -> str:
    """Save ``model`` as a new version; returns the version string."""
    version = version or _now_version()
    path = f"{root.rstrip('/')}/{name}/{version}"
    model.write().save(path)  # never overwrites: a clash raises
    row = [(name, version, path, _dt.datetime.now(_dt.timezone.utc).isoformat(), json.dumps(metrics or {}))]
    spark.createDataFrame(row, "name string, version string, path string, created_at string, metrics string") \
        .coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{REGISTRY}")
    return version


def versions(spark: SparkSession, root: str, name: str):
    return spark.read.parquet(f"{root.rstrip('/')}/{REGISTRY}").where(F.col("name") == name)


def latest_version(spark: SparkSession, root: str, name: str) -> str | None:
    r = versions(spark, root, name).agg(F.max("version").alias("v")).first()
    return r.v if r else None


def load_model(spark: SparkSession, root: str, name: str, version: str | None = None) -> PipelineModel:
    """Load a version (default: the latest) of model ``name``."""
    v = version or latest_version(spark, root, name)
    if v is None:
        raise FileNotFoundError(f"no saved versions of model {name!r} under {root}")
    return PipelineModel.load(f"{root.rstrip('/')}/{name}/{v}")
