"""Question/answer corpora from catalog tables, built with Spark DataFrames."""

from .operators.domains import REGISTRY, DomainSpec, register
from .operators.ledger import Ledger
from .plans.extract import Run, extract_domain, run, scan_catalog, scan_catalog_details
from .plans.inspect import coverage, stats
from .plans.publish import open_store, publish_run, push, push_file, push_snapshots, validate
from .settings import ExtractionConfig, build_session
from .streaming.follow import follow, open_landing

__all__ = [
    "REGISTRY",
    "DomainSpec",
    "ExtractionConfig",
    "Ledger",
    "Run",
    "build_session",
    "coverage",
    "extract_domain",
    "follow",
    "open_landing",
    "open_store",
    "publish_run",
    "push",
    "push_file",
    "push_snapshots",
    "register",
    "run",
    "scan_catalog",
    "scan_catalog_details",
    "stats",
    "validate",
]
