"""Operators over event, log and metric tables. Every function takes and returns DataFrames."""

from signalyard.operators.behavior import (
    CART_TO_ORDER,
    TRIAL_TO_PAID,
    abandonment,
    auth_failures,
    funnel,
    funnel_users,
    retention,
    retention_table,
    time_between,
)
from signalyard.operators.delivery import (
    batch_gaps,
    dedupe_batches,
    dedupe_exact,
    pack_batches,
    retain_newest_bytes,
    route_by_schema,
    unpack_batches,
    with_row_id,
)
from signalyard.operators.events import (
    active_ratio,
    active_users,
    engagement_rates,
    event_counts,
    latency_sketch,
    latency_summary,
    subscription_state,
    throughput,
    wire_volume,
)
from signalyard.operators.filters import (
    custom_only,
    min_severity,
    standard_only,
    where_label,
    where_prop,
    where_signal,
)
from signalyard.operators.histograms import (
    bucketize,
    histogram_increase,
    histogram_merge,
    histogram_quantile,
    sorted_buckets,
)
from signalyard.operators.identity import apply_identity, resolve_identities
from signalyard.operators.identity_store import IdentityStore
from signalyard.operators.joins import (
    asof_group,
    asof_profile,
    asof_super_props,
    events_with_logs,
    logs_near_event,
    metrics_align,
    net_revenue,
    orphan_aliases,
    reconcile_batches,
    super_property_states,
    users_with,
    users_without,
)
from signalyard.operators.logs import error_rate, log_counts
from signalyard.operators.maintained import DailyCounts, DailyRevenue
from signalyard.operators.metrics import (
    counter_increase,
    counter_normalize,
    counter_steps,
    counter_sum,
    gauge_stats,
    label_cardinality,
    moving_gauge,
    series_cardinality,
)
from signalyard.operators.ordering import latest_n, rank_users, timeline, top_k
from signalyard.operators.payloads import (
    alias_payload,
    event_category,
    explode_props,
    extract_props,
    group_payload,
    identify_payload,
    log_payload,
    merge_properties,
    payload_size,
    revenue_payload,
    track_payload,
)
from signalyard.operators.profiles import (
    current_groups,
    group_members,
    group_profiles,
    latest_traits,
    user_profiles,
)
from signalyard.operators.quality import distinct_props, prop_stats, property_registry
from signalyard.operators.revenue import revenue_cube, revenue_summary, running_revenue
from signalyard.operators.sessions import (
    event_sequence,
    first_last_touch,
    gap_sessions,
    paths,
    session_summary,
    sessionize_gap,
    sessionize_reset,
)
from signalyard.operators.sets import mixed_metrics, unified_timeline, users_in_both, users_lost
from signalyard.operators.sketches import (
    compare_periods,
    estimated_users,
    merge_user_sketches,
    merge_value_sketches,
    rank_error,
    sketched_quantiles,
    user_bound,
    user_sketches,
    value_sketches,
)
from signalyard.operators.stamping import (
    decode_enums,
    decode_tenant_key,
    encode_enums,
    envelope_defaults,
    metric_defaults,
    normalize_ts,
    series_key,
    stamp_service,
    stamp_session,
    stamp_source,
    tenant_digest,
)
from signalyard.operators.validation import (
    split_valid,
    validate_alias,
    validate_group,
    validate_histogram,
    validate_identify,
    validate_log,
    validate_metric,
    validate_payload,
    validate_revenue,
    validate_service,
    validate_session_policy,
    validate_signals,
    validate_tenant_key,
    validate_track,
    validation_report,
)
from signalyard.operators.validity import ValidityTable

__all__ = [name for name in dir() if not name.startswith("_") and name not in (
    "behavior", "delivery", "events", "filters", "histograms", "identity", "identity_store", "joins", "keys", "logs",
    "metrics", "ordering", "payloads", "profiles", "quality", "revenue", "sessions", "sets", "sketches",
    "stamping", "validation", "validity",
)]
