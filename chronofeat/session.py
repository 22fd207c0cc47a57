"""Session helpers: the scratch location for written tables and a test/bench
session builder.  Library code never creates a session on its own; it uses
the DataFrame's session."""

from __future__ import annotations

import os
import uuid
from typing import Optional

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is the shared (HDFS / object store) location every
    executor can reach; it is read from the session.  Only when it is unset
    and the master is local (tests, local runs) a local scratch folder is
    created and registered."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:                                   # classic sessions only (not Spark Connect)
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", None) or (sc.master if sc is not None else "") or ""
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS / object store) "
                             "every executor can reach; a machine-local folder is not safe on a cluster")
        import tempfile
        d = tempfile.mkdtemp(prefix="chronofeat-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        if sc is not None:
            sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder."""
    return f"{shared_dir(spark)}/chronofeat/{name}-{uuid.uuid4().hex}"


def local_session(cores: Optional[int] = None, shuffle_partitions: Optional[int] = None,
                  app: str = "chronofeat") -> SparkSession:
    """Session used by tests and the bench (``local[N]``, UI off, UTC, AQE)."""
    n = cores or int(os.environ.get("BENCH_CPUS", "8"))
    sp = shuffle_partitions or n
    b = (SparkSession.builder.master(f"local[{n}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", str(sp))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", os.environ.get("CHRONOFEAT_DRIVER_MEMORY", "8g")))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark
