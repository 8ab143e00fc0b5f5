"""Session-level settings the library reads but never invents.

Lineage is cut with reliable checkpoints or written tables under the shared
folder the cluster names in ``spark.checkpoint.dir``.  The library refuses to
run those steps when it is unset; only tests and local tools may set one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def _sc(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        return None


def _conf_dir(spark: SparkSession) -> str | None:
    try:
        return spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        return None


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session; raise when none is set."""
    sc = _sc(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if not d:
        d = _conf_dir(spark) or (sc.getConf().get("spark.checkpoint.dir", None) if sc else None)
        if d and sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: starmart needs a shared folder "
            "(HDFS/S3/ABFS/...) to checkpoint and stage tables")
    return d.rstrip("/")


def ensure_shared_dir(spark: SparkSession) -> str:
    """As ``shared_dir``; a session on a local master without a folder gets a
    fresh one in /tmp.  On a cluster a machine-local folder would not do, so
    there an unset folder raises."""
    sc = _sc(spark)
    unset = (sc is not None and not sc.getCheckpointDir()
             and not sc.getConf().get("spark.checkpoint.dir", None) and not _conf_dir(spark))
    if unset and sc.master.startswith("local") and not sc.master.startswith("local-cluster"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return shared_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{shared_dir(spark)}/starmart-scratch/{uuid.uuid4().hex}/{name}"


def _norm(path: str) -> str:
    scheme, colon, rest = path.partition(":")
    if colon and scheme == "file":
        path = "/" + rest.lstrip("/")
    head, sep, tail = path.partition("://")
    return f"{head}{sep}{os.path.normpath(tail)}" if sep else os.path.normpath(path)


def overlaps(a: str, b: str) -> bool:
    """Whether two paths are equal or one lies inside the other."""
    a, b = _norm(a), _norm(b)
    return a == b or a.startswith(b.rstrip("/") + "/") or b.startswith(a.rstrip("/") + "/")
