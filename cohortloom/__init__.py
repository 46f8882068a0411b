"""Product-funnel analytics as Spark DataFrame jobs.

Every public job is a function ``DataFrame -> DataFrame`` built from
built-in Spark expressions, so Catalyst and adaptive execution plan it.
"""

from cohortloom.session import build_session, ensure_checkpoint_dir
from cohortloom.sources.events import landed_max, read_daily, read_intraday, read_shards, union_events
from cohortloom.operators.signup import signup_country_method_daily
from cohortloom.operators.reshape import daily_totals, method_matrix_array, method_matrix_tall, payloads
from cohortloom.operators.experiment import assignment_events, assignment_status, health_counts
from cohortloom.operators.funnel import country_funnel, funnel_by_country, funnel_metrics, funnel_reach
from cohortloom.operators.alerts import event_completeness, hourly_counts, version_drop, zero_runs
from cohortloom.operators.payments import device_orders, mature_rate, order_totals, verdict_state
from cohortloom.operators.feedback import checked_feedback, feedback_routes, transcript, transcript_lines
from cohortloom.operators.workflow import (handoff_missing, pool_to_release, release_by_type, release_list,
                                           status_audit, version_mismatch)

__all__ = [
    "build_session", "ensure_checkpoint_dir",
    "landed_max", "read_daily", "read_intraday", "read_shards", "union_events",
    "signup_country_method_daily",
    "daily_totals", "method_matrix_array", "method_matrix_tall", "payloads",
    "assignment_events", "assignment_status", "health_counts",
    "country_funnel", "funnel_by_country", "funnel_metrics", "funnel_reach",
    "event_completeness", "hourly_counts", "version_drop", "zero_runs",
    "device_orders", "mature_rate", "order_totals", "verdict_state",
    "checked_feedback", "feedback_routes", "transcript", "transcript_lines",
    "handoff_missing", "pool_to_release", "release_by_type", "release_list", "status_audit", "version_mismatch",
]
