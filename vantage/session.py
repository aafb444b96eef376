"""Spark session defaults and the shared checkpoint folder.

On a cluster the session already carries ``spark.checkpoint.dir`` (a shared
folder); we read it and never replace it.  Only when it is unset (tests, local
runs) do we pick a private scratch folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "vantage",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session, None for a remote (Connect) one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no context
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder (``spark.checkpoint.dir``).  Only a
    local master may leave it unset and gets a scratch one (tests)."""
    sc = _context(spark)
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir and sc is not None:
        conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="vantage-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if sc is not None:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    return conf_dir


def shared_dir(spark: SparkSession) -> str:
    """Folder for written tables and files that driver and executors all see."""
    return ensure_checkpoint_dir(spark)


def scratch_root(spark: SparkSession) -> str:
    """The application's own part of the shared folder: intermediate tables and files go here."""
    sc = _context(spark)
    own = sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "session")
    return f"{shared_dir(spark).rstrip('/')}/vantage-{own}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what the application wrote under ``scratch_root``.  Results that were not read or
    written elsewhere yet lose their tables, so call it when a session's work is done."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
