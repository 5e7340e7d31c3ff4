"""Maintenance statements for sessions that have the Delta extension.

Delta tables keep their own log, so compaction, clustering and file removal are
left to its commands. Plain Parquet tables use ``strata.sources.maintenance``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from strata.sources.maintenance import RETENTION_HOURS

# Session settings that switch the Delta extension on.
DELTA_SETTINGS = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def optimize(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> None:
    """Compact the Delta table at ``path``, clustered by ``columns`` if given."""
    cluster = f" ZORDER BY ({', '.join(map(_quoted, columns))})" if columns else ""
    spark.sql(f"OPTIMIZE delta.{_quoted(path)}{cluster}")


def vacuum(spark: SparkSession, path: str, retention_hours: int = RETENTION_HOURS) -> None:
    """Delete the Delta table's unreferenced files older than the retention."""
    spark.sql(f"VACUUM delta.{_quoted(path)} RETAIN {int(retention_hours)} HOURS")
