"""Analytics over large collections of postings and documents, on Spark."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it (a cluster gets it by --py-files)."""
    root, environment = str(Path(__file__).resolve().parent.parent), spark.sparkContext.environment
    known = environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])
