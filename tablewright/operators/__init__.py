"""DataFrame operators."""

from tablewright.operators.choice import choice_types, open_records, resolve_choice
from tablewright.operators.joins import enrich, unmatched
from tablewright.operators.latest import latest_per_key
from tablewright.operators.mapping import apply_mapping, preview, schema_report, stringify
from tablewright.operators.quality import split_rejects, with_counters
from tablewright.operators.relational import relationalize
from tablewright.operators.summary import daily_engagement_kpis, summarize

__all__ = [
    "apply_mapping", "choice_types", "daily_engagement_kpis", "enrich", "latest_per_key",
    "open_records", "preview", "relationalize", "resolve_choice", "schema_report",
    "split_rejects", "stringify", "summarize", "unmatched", "with_counters",
]
