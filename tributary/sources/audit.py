"""Missing-input audit.

The reference checks one object per call and builds an alert record when it is
missing.  Here the whole manifest of expected inputs is compared with what was
observed in one anti-join, and every missing input becomes an alert row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields of the alert record.
ALERT_FIELDS = ("project", "bucket", "file_name", "alert", "reason")


def missing_inputs(expected: DataFrame, observed: DataFrame, key: str,
                   project: str, bucket: str,
                   reason: str = "expected input not found") -> DataFrame:
    """Alert rows (project, bucket, file_name, alert, reason) for each expected
    key with no observed row.  ``left_anti`` keeps NULL-safe semantics."""
    miss = expected.select(key).distinct().join(observed.select(key), on=key, how="left_anti")
    return miss.select(
        F.lit(project).alias("project"),
        F.lit(bucket).alias("bucket"),
        F.col(key).cast("string").alias("file_name"),
        F.lit("MISSING_INPUT").alias("alert"),
        F.lit(reason).alias("reason"))
