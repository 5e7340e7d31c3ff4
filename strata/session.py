"""Session factory and cluster sizing."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime settings every job wants. Exact text of JSON numbers that are read as
# text costs about ten times the parse; the contracts only need their value.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.json.enableExactStringParsing": "false",
}

MIB = 1024 * 1024
GIB = 1024 * MIB


def sizing(input_bytes: int) -> dict[str, str]:
    """Scan, shuffle and file-size settings for a job that reads ``input_bytes``.

    Splits and files grow with the input between Spark's defaults and four times
    these, so that task and file counts stay manageable. A reduce partition gets up to a gibibyte of input (less once columns are pruned);
    adaptive execution merges what turns out small and splits what is skewed.
    """
    grown = min(4 * MIB, max(MIB, input_bytes // (1024 * 1024)))
    return {
        "spark.sql.shuffle.partitions": str(max(200, -(-input_bytes // GIB))),
        "spark.sql.files.maxPartitionBytes": str(128 * grown),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(64 * grown),
    }


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that was built elsewhere."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def get_session(
    app_name: str = "strata",
    *,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the running session, or build one with the project's settings.

    ``conf`` wins over the defaults. The broadcast threshold stays at Spark's
    size-checked 10 MiB and adaptive execution is on, so a join side is
    broadcast only when its measured size allows it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    settings = {
        **RUNTIME,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }
    if input_bytes is not None:
        settings |= sizing(input_bytes)
    settings |= conf or {}
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
