"""SparkSession construction with the settings every report relies on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings the reports assume. Adaptive execution re-plans joins from runtime
# sizes (small lookups become broadcast joins only once their real size is
# known), coalesces small shuffle partitions and splits skewed ones.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # per-invoice stages carry heavy decimal expressions over little data; a
    # lower floor keeps small shuffles spread over the cores (large shuffles
    # are still cut at the advisory size)
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # generated methods above the JVM's JIT limit would run interpreted; let
    # Spark fall back to its compiled expression path for them instead
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str | None = None, app: str = "tallybook",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Return a session configured for the reports.

    ``master`` is only for local runs and tests; on a cluster leave it None so
    the launcher's setting applies.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is read as is.
    Only in a single-machine session (master ``local`` or ``local[...]``) that
    leaves it unset a fresh local folder is made, once for the session.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tallybook-ckpt-")
        sc.setCheckpointDir(d)
    return d
