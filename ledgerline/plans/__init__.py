from ledgerline.plans import battery_queries, cascade_queries, check_queries, filter_queries, listing_queries, pit_queries, report_queries, study_queries, universe_queries, validation_queries  # noqa: F401
from ledgerline.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
