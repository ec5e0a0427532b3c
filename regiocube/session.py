"""Session construction and the shared scratch location.

Jobs never invent a machine-local temp folder: intermediate tables go under
the cluster's ``spark.checkpoint.dir``. Only local sessions built here (tests,
bench) set that option, and only when the caller left it unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults sized for local[N]; on a cluster the submitter's settings win.
_LOCAL_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The fact join is followed by an aggregation on the join key, so a plain
    # skew split would break the required partitioning and AQE would skip it.
    # Forced, AQE splits a hot order key and adds an exchange only when it
    # measures skew at run time; unskewed plans are unchanged.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A batch submits several datasets at once, each to a pool of its own.
    "spark.scheduler.mode": "FAIR",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Marts are small per key; 128 MB splits keep scan tasks well inside
    # executor memory for the wide raw cubes.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(
    app: str = "regiocube",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    checkpoint_dir: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    ``checkpoint_dir`` is applied only when the session has none yet; when
    both are missing, a local master (tests, bench) gets a fresh
    ``mktemp -d`` style folder and a cluster master gets none (a machine-local
    folder is never used on a cluster; what needs one raises).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in _LOCAL_DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if scratch_root(spark) is None:
        path = checkpoint_dir
        if path is None and spark.sparkContext.master.startswith("local"):
            path = tempfile.mkdtemp(prefix="regiocube-ckpt-")
        if path is not None:
            spark.sparkContext.setCheckpointDir(path)
            spark.conf.set("regiocube.scratch", path)
    return spark


def scratch_root(spark: SparkSession) -> str | None:
    """The shared folder for intermediate tables, or None when unset.

    Read from the session: ``spark.checkpoint.dir`` (cluster config) first,
    then a checkpoint directory set on the context at run time. A ``file:``
    path is refused on a cluster master (its executors do not share it);
    masters that run on this machine (``local``, ``local-cluster``) may use one.
    """
    conf = spark.sparkContext.getConf()
    root = conf.get("spark.checkpoint.dir", None) or spark.conf.get("regiocube.scratch", None)
    ckpt = spark.sparkContext.getCheckpointDir()
    if not root and ckpt:
        # setCheckpointDir appends a per-application uuid folder; share its parent.
        root = os.path.dirname(ckpt.rstrip("/"))
    if root:
        check_shared(root, spark.sparkContext.master)
    return root or None


def check_shared(root: str, master: str) -> None:
    """Raise for a machine-local scratch folder on a cluster master."""
    if root.startswith("file:") and not master.startswith("local"):
        raise ValueError(f"spark.checkpoint.dir {root} is local to one machine; name a shared folder")
