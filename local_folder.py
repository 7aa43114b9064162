"""A scratch folder for sessions that run on one machine (tests, bench,
smoke runs); on a cluster ``spark.checkpoint.dir`` names the shared one."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def set_if_local(spark: SparkSession) -> None:
    """Name a scratch folder where none is set and the master is ``local[...]``."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named and (sc.master == "local" or sc.master.startswith("local[")):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-"))
