"""Splitting inputs that arrive in fewer pieces than there are cores."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan out to all cores if it has fewer splits than that.

    Meant for per-row text work over a few unsplittable files.  A large table always has more
    splits than the cluster has cores and is returned as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
