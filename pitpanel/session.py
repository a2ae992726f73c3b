"""Session helpers (tests, bench): local session and checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pitpanel") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's ``spark.checkpoint.dir``; only when it is unset and the
    master runs in this process (tests) fall back to a fresh scratch folder."""
    try:
        sc = spark.sparkContext
    except Exception:   # a remote (Connect) session: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    d = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="pitpanel-ckpt-")
    sc.setCheckpointDir(d)
    return d
