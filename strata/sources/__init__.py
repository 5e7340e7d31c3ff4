"""Contracts, readers, writers, maintenance jobs and scratch folders."""

from strata.sources.contracts import (
    LOGISTICS_CONTRACT,
    SALES_CONTRACT,
    LayerPaths,
    conform,
)
from strata.sources.maintenance import compact, orphan_files, zorder
from strata.sources.json_split import read_json_array
from strata.sources.partitions import replace_partitions
from strata.sources.readers import read_csv_contract, read_json_contract, read_table
from strata.sources.rescued import read_json_rescued
from strata.sources.skipping import read_ranges, write_file_stats
from strata.scratch import scratch_dir, scratch_scope
from strata.sources.upsert import upsert_latest
from strata.sources.writers import append_table, overwrite_table, skip_seen, write_bucketed

__all__ = [
    "LOGISTICS_CONTRACT",
    "SALES_CONTRACT",
    "LayerPaths",
    "append_table",
    "compact",
    "conform",
    "orphan_files",
    "overwrite_table",
    "read_csv_contract",
    "read_json_array",
    "read_json_contract",
    "read_json_rescued",
    "read_ranges",
    "read_table",
    "replace_partitions",
    "scratch_dir",
    "scratch_scope",
    "skip_seen",
    "upsert_latest",
    "write_bucketed",
    "write_file_stats",
    "zorder",
]
