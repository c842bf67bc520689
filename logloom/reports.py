"""Every report by name, over the tables of a warehouse.

A table that was never written reads as an empty one with its columns, so each
report always returns a DataFrame of the same shape.
"""

from functools import partial

from logloom.operators import catalogs, gaps, investigate, manifest, metrics
from logloom.sources import logs
from logloom.sources.tables import Warehouse

_EVENTS, _SPANS = "event_fact_api", "span_fact"
_LOOSE, _GAPS, _CAPABILITIES = "cobrand_event_fact", "instrumentation_gap_catalog", "capability_catalog"

# report -> (operator, the tables it reads, in order)
REPORTS = {
    "date_bounds": (metrics.date_bounds, (_EVENTS, _SPANS)),
    "failure_breakdown": (metrics.failure_breakdown, (_EVENTS, _SPANS)),
    "kpis": (metrics.kpis, (_EVENTS, _SPANS)),
    "structured_rate": (metrics.structured_rate, (_EVENTS,)),
    "day_over_day": (metrics.day_over_day, (_EVENTS, _SPANS)),
    "events_over_time": (metrics.events_over_time, (_EVENTS,)),
    "errors_over_time": (metrics.errors_over_time, (_EVENTS,)),
    "failures_over_time": (metrics.failures_over_time, (_EVENTS, _SPANS)),
    "failures_by_source": (metrics.failures_by_source, (_EVENTS, _SPANS)),
    "top_services": (metrics.top_services, (_EVENTS,)),
    "top_platforms": (metrics.top_platforms, (_EVENTS,)),
    "top_errors": (metrics.top_errors, (_EVENTS,)),
    "top_failed_events": (metrics.top_failed_events, (_EVENTS,)),
    "top_users_with_errors": (metrics.top_users_with_errors, (_EVENTS,)),
    "top_planners_with_errors": (metrics.top_planners_with_errors, (_EVENTS,)),
    "top_event_prefixes": (catalogs.top_event_prefixes, (_CAPABILITIES,)),
    "service_health": (metrics.service_health, (_EVENTS,)),
    "platform_health": (metrics.platform_health, (_EVENTS,)),
    "cobrand_health": (metrics.cobrand_health, (_SPANS,)),
    "failure_table": (investigate.failure_table, (_EVENTS, _SPANS, _GAPS)),
    "user_summary": (investigate.user_summary, (_EVENTS, _SPANS)),
    "user_values": (investigate.user_values, (_EVENTS,)),
    "user_timeline": (investigate.user_timeline, (_EVENTS, _SPANS, _GAPS)),
    "workflow_events": (investigate.workflow_events, (_EVENTS, _SPANS, _GAPS)),
    "workflow_steps": (investigate.workflow_steps, (_EVENTS, _SPANS, _GAPS)),
    "labelled_failures": (investigate.labelled_failures, (_EVENTS, _SPANS, _GAPS)),
    "workflow_summary": (investigate.workflow_summary, (_EVENTS, _SPANS)),
    "search_logs": (investigate.search_logs, (_EVENTS, _SPANS, _LOOSE, _GAPS)),
    "coverage_kpis": (catalogs.coverage_kpis, (_CAPABILITIES,)),
    "capability_table": (catalogs.capability_table, (_CAPABILITIES,)),
    "capability_backlog": (catalogs.capability_backlog, (_CAPABILITIES,)),
    "recent_discoveries": (catalogs.recent_discoveries, (_CAPABILITIES,)),
    "gap_kpis": (gaps.gap_kpis, (_GAPS,)),
    "gap_table": (gaps.gap_table, (_GAPS,)),
    "gap_backlog": (gaps.gap_backlog, (_GAPS,)),
    "signature_patterns": (gaps.signature_patterns, (_GAPS,)),
    "dimension_backlog": (catalogs.dimension_backlog, ("dim_span",)),
    "api_quality": (logs.quality_report, ("raw_api",)),
    "cobrand_quality": (logs.quality_report, ("raw_cobrand",)),
    "load_failures": (lambda failures: failures, ("load_failures",)),
    "last_activity": (manifest.last_activity, ("archive_manifest",)),
    "safe_to_purge": (manifest.safe_to_purge, ("archive_manifest",)),
}


class Reports:
    """``Reports(warehouse).kpis(start, end)`` and so on; arguments are the operator's own."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse

    def __getattr__(self, name: str):
        if name not in REPORTS:
            raise AttributeError(name)
        operator, tables = REPORTS[name]
        return partial(operator, *[self.warehouse.read(t) for t in tables])

    def __dir__(self):
        return [*super().__dir__(), *REPORTS]

    def inventory(self):
        return self.warehouse.inventory()

    page = staticmethod(investigate.page)
    last_of = staticmethod(investigate.last_of)

    def export_csv(self, rows, path: str) -> None:
        """Save a result as CSV with a header."""
        rows.write.mode("overwrite").option("header", True).csv(path)
