"""Session helpers: builder defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "tabsmith",
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Session with the settings every operator assumes, where the submitted configuration has none.

    AQE on (coalescing, skew-join splitting), the UI off, time in UTC so date parts do not
    depend on the host. A value given with the submission wins over these defaults; ``extra``
    and ``shuffle_partitions`` are the caller's own words and win over both.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        # a running session (a cluster job, a notebook) keeps its own settings
        ensure_checkpoint_dir(active)
        return active
    own = dict(extra or {})
    if shuffle_partitions:
        own.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    # start the JVM with the caller's settings (its memory is fixed at launch), or join the submitted one
    launch = SparkConf(loadDefaults=False)
    for k, v in own.items():
        launch.set(k, str(v))
    SparkContext._ensure_initialized(conf=launch)
    submitted = SparkConf()
    defaults = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.adaptive.enabled": "true",
                "spark.sql.adaptive.coalescePartitions.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true",
                "spark.sql.session.timeZone": "UTC", "spark.app.name": app}
    if master:
        defaults["spark.master"] = master
    if (master or submitted.get("spark.master", "local")).startswith("local"):
        defaults["spark.sql.shuffle.partitions"] = str(os.cpu_count() or 8)  # one JVM: as many as it has cores
    b = SparkSession.builder
    for k, v in {**{k: v for k, v in defaults.items() if not submitted.contains(k)}, **own}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder; it is read from the
    session. Only a local session without one gets a fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabsmith-ckpt-"))
    return sc.getCheckpointDir()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
