"""DataFrame operators: audit, shaping, dedup, quality, joins, windows, caching."""

from strata.operators.audit import stamp_layer, with_audit, with_ingestion_year
from strata.operators.caching import cached
from strata.operators.dedup import dedup_latest, dedup_stats
from strata.operators.heavy import Heavy, broadcast_if_small, heavy_keys, join_heavy
from strata.operators.joins import (
    attach,
    enrich_left,
    preaggregate,
    preaggregate_then_left_join,
)
from strata.operators.quality import null_gate, profile, rejected, row_count
from strata.operators.shaping import (
    calendar_parts,
    fill_defaults,
    normalize_text,
    preview,
    require_not_null,
)
from strata.operators.windows import growth_pct, rank_within, share_of_total

__all__ = [
    "attach",
    "cached",
    "calendar_parts",
    "dedup_latest",
    "dedup_stats",
    "enrich_left",
    "fill_defaults",
    "Heavy",
    "broadcast_if_small",
    "growth_pct",
    "heavy_keys",
    "join_heavy",
    "normalize_text",
    "null_gate",
    "preaggregate",
    "preaggregate_then_left_join",
    "preview",
    "profile",
    "rank_within",
    "rejected",
    "require_not_null",
    "row_count",
    "share_of_total",
    "stamp_layer",
    "with_audit",
    "with_ingestion_year",
]
