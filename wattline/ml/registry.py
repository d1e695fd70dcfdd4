"""Versioned model registry on shared storage (ML-09, ML-10, ML-11).

Models live at `<root>/<name>/v=<n>`; the registry is a Parquet table with
one row per (name, version). A push claims the next version by an exclusive
create before it writes, so pushes at once get versions of their own.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.contracts import REGISTRY_SCHEMA
from wattline.ml.metrics import latest_version
from wattline.ml.models import load_model, save_model
from wattline.operators.commits import Log
from wattline.operators.tables import create_table_if_absent

_SCHEMA_WITH_KIND = T.StructType(REGISTRY_SCHEMA.fields + [T.StructField("kind", T.StringType(), True)])


def _registry(spark: SparkSession, root: str):
    return create_table_if_absent(spark, f"{root}/_registry", _SCHEMA_WITH_KIND)


def latest(spark: SparkSession, root: str, name: str) -> int | None:
    """Latest version number of `name`, or None."""
    row = latest_version(_registry(spark, root).where(F.col("name") == name)).first()
    return None if row is None else row["latest_version"]


def push(spark: SparkSession, root: str, name: str, model, run_id: str | None = None) -> int:
    """Save the model as a new version and record it; returns the version."""
    log = Log(spark, f"{root}/{name}")
    version = max(latest(spark, root, name) or 0, log.last()) + 1
    while not log.claim(version):
        version += 1
    path = f"{root}/{name}/v={version}"
    kind = save_model(model, path)
    row = (name, str(version), path, run_id or uuid.uuid4().hex,
           datetime.now(timezone.utc).replace(tzinfo=None), kind)
    _registry(spark, root)
    rows = Log(spark, f"{root}/_registry")
    rows.add(spark.createDataFrame([row], _SCHEMA_WITH_KIND).coalesce(1))
    return version


def pull(spark: SparkSession, root: str, name: str, version: int | None = None):
    """Load a version (default: the latest). No version -> a clear error."""
    version = version if version is not None else latest(spark, root, name)
    if version is None:
        raise LookupError(f"no registered version of model {name!r}")
    rows = (_registry(spark, root)
            .where((F.col("name") == name) & (F.col("version").try_cast("int") == version))
            .select("path", "kind").collect())
    if not rows:
        raise LookupError(f"model {name!r} has no version {version}")
    return load_model(spark, rows[0]["path"], rows[0]["kind"])
