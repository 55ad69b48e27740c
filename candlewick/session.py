"""Session helpers: one place for the settings every operator relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators assume.  UTC is part of the semantics (day boundaries,
# epoch-millis conversion); AQE re-plans joins / coalesces partitions at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "candlewick",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or get) a session with the defaults above.  On a cluster, leave
    ``master`` to spark-submit and size ``shuffle_partitions`` to the data."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_semantics(spark: SparkSession) -> None:
    """Pin the settings whose values change results (session zone), and make the
    package importable by executor Python workers."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)


_SHIPPED_KEY = "candlewick.pyfile"


def ship_package(spark: SparkSession) -> None:
    """``addPyFile`` a zip of this package once per session (what ``--py-files``
    does at submit time), so Arrow batch functions resolve on every executor
    whatever the driver's working directory is."""
    if spark.conf.get(_SHIPPED_KEY, None):
        return
    import os
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="candlewick-pyfiles-"), "candlewick.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    spark.sparkContext.addPyFile(out)
    spark.conf.set(_SHIPPED_KEY, out)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and intermediate tables.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (HDFS / object
    store, visible to every executor).  Only when the session does not name one
    (tests, local runs) do we create a local folder and register it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.sparkContext.getCheckpointDir()
        except Exception:  # pragma: no cover - Spark Connect has no SparkContext
            root = None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="candlewick-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique directory path under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/candlewick/{name}-{uuid.uuid4().hex[:12]}"


def staged(df, name: str):
    """Write ``df`` once to the shared scratch folder and read it back: several uses
    read the files instead of repeating its work."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_fs_path(path: str) -> str:
    """``file:`` URI -> plain local path (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path
