"""Stored web pages to a clean, deduplicated content library, as Spark jobs."""

from folioflow.plans.site_run import RunStore, dry_run, run_batch, run_sites
from folioflow.rules import SiteRules, default_rules
from folioflow.streaming.flow import read_page_stream, run_stream

__all__ = [
    "RunStore",
    "SiteRules",
    "default_rules",
    "dry_run",
    "read_page_stream",
    "run_batch",
    "run_sites",
    "run_stream",
]
