"""Session settings the library relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# LAST_WIN keeps the first position and the last value of a repeated field, in decode and in
# merge alike.  The two legacy charset settings make `decode` accept every JVM charset and
# replace malformed bytes by U+FFFD in place of failing.
SETTINGS = {
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.legacy.codingErrorAction": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings; safe to call any number of times.

    Functions of this package travel to the Python workers by value, so that the package need
    not be installed on the executors.
    """
    cloudpickle.register_pickle_by_value(sys.modules["dimweave"])
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession, *parts: str) -> str:
    """A path below the checkpoint folder of the cluster, which every executor can reach.

    Where `spark.checkpoint.dir` is unset, a local master gets a temporary folder of its own;
    on a cluster that is an error, because the executors would not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="dimweave-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return "/".join([root.rstrip("/"), *parts])


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder below the shared one that no other run uses."""
    return shared_folder(spark, "dimweave", f"{name}-{uuid.uuid4().hex}")
