from types import ModuleType as _ModuleType

from .bronze import (
    detect_version,
    file_version,
    keep_payload,
    payload_fields,
    payload_schema,
    rescue_unknown,
    stamp_ingest,
    tag_provenance,
    union_versions,
)
from .checks import CHECKS, Check, compare, measure, reconcile
from .cleanse import (
    DEFAULT_REJECTIONS,
    Rejection,
    label_quarantine,
    normalise,
    parse_event_time,
    split,
    unify_columns,
    with_offset,
)
from .dedup import dedup_latest, duplicate_keys, exact_dedup, purge_keys
from .deltas import (
    changed_activity,
    merge_state,
    refresh_rolling,
    refresh_streaks,
    replaced_rows,
    spend_of_state,
    spend_state,
    stale_frames,
    state_changes,
)
from .dimension import join_dimension, orphans, unique_dimension, unknown_names
from .fingerprints import differing_nodes, fingerprints, layer_differences
from .money import fill_daily, to_usd, to_usd_daily
from .quality import DataQualityError, Rule, dq_report, enforce, run_dq_checks
from .rollup import daily_spend, on_days, refresh_days
from .sketches import distinct_bounds, uniqueness, value_sketches
from .trends import active_days, first_days, longest_streak, rolling_spend, streaks
from .upsert import (
    beating,
    days_of_change,
    held_rows,
    merge_statement,
    replace_rows,
    touched_days,
    upsert_latest,
    winning_rows,
)

__all__ = [n for n, v in list(globals().items()) if not n.startswith("_") and not isinstance(v, _ModuleType)]
