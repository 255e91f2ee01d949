"""Session for tests and the bench, and the shared scratch folder of a job."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: str = "8", app: str = "rollbook", memory: str = "16g") -> SparkSession:
    """A local session; on a cluster the session is made by spark-submit and passed in."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's ``spark.checkpoint.dir``.

    Only in a local session may that setting be unset: a temporary folder of this machine is taken then.
    On a cluster executors would write to disks of their own, so it is an error there.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/rollbook/{name}-{uuid.uuid4().hex[:12]}"
    master = spark.conf.get("spark.master", "")
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
    return tempfile.mkdtemp(prefix=f"rollbook-{name}-")
