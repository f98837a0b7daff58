"""Settings passed explicitly to every job, and the session defaults the jobs expect."""

from __future__ import annotations

import atexit
import os
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Run constants that results depend on.
SEED = 42
CV_FOLDS = 5
HOLDOUT_SHARE = 0.15
INNER_VALIDATION_SHARE = 0.10
PATIENCE_ROUNDS = 50
MAX_ROUNDS = 2000
IMPORTANCE_SAMPLE = 2000
LOW_RISK_BELOW = 0.08
MEDIUM_RISK_BELOW = 0.20


@dataclass(frozen=True)
class Settings:
    """Where data lives, which columns play which part, and how models are trained."""

    raw_dir: str = field(default_factory=lambda: os.environ.get("DATA_RAW_DIR", "data/raw"))
    warehouse_dir: str = field(default_factory=lambda: os.environ.get("WAREHOUSE_DIR", "data/warehouse"))
    model_dir: str = field(default_factory=lambda: os.environ.get("MODEL_DIR", "models"))
    reports_dir: str = field(default_factory=lambda: os.environ.get("REPORTS_DIR", "reports"))
    id_col: str = "sk_id_curr"
    label_col: str = "target"
    split_col: str = "is_train"
    seed: int = SEED
    folds: int = CV_FOLDS
    holdout_share: float = HOLDOUT_SHARE
    inner_validation_share: float = INNER_VALIDATION_SHARE
    patience: int = PATIENCE_ROUNDS
    max_rounds: int = MAX_ROUNDS
    importance_sample: int = IMPORTANCE_SAMPLE
    parallel_fits: int = 8  # independent fits at a time; small data fits on one core each

    @property
    def non_features(self) -> tuple[str, str, str]:
        return (self.id_col, self.label_col, self.split_col)


# The mart is wider than Spark's default limit of 100 fields for whole-stage
# codegen, so jobs that carry the whole row need the higher limit.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.maxFields": "400",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app_name: str = "grainmart", **conf: str) -> SparkSession:
    shared = {"spark.checkpoint.dir": f"{Settings().warehouse_dir}/_checkpoints"}
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **shared, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; where none is named, one in its warehouse.

    Both are places that all executors share. A folder of one machine is never made up.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
        if not warehouse:
            raise ValueError("name a shared folder in spark.checkpoint.dir or spark.sql.warehouse.dir")
        named = f"{warehouse.rstrip('/')}/_checkpoints"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


_SCRATCH: set[str] = set()


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder of intermediate tables, removed when the driver's process ends."""
    path = f"{ensure_checkpoint_dir(spark)}/grainmart-{spark.sparkContext.applicationId}"
    if path not in _SCRATCH:
        _SCRATCH.add(path)
        atexit.register(_remove, spark.sparkContext._jvm, path)
    return path


def _remove(jvm, path: str) -> None:
    try:
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(folder, True)
    except Exception:  # noqa: BLE001  the JVM may be gone already; the folder then stays behind
        pass
