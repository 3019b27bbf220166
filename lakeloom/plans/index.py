"""Every registered query, imported in one place for ``__spark_entry__``."""

from . import catalog, catalog_jobs, catalog_quality, catalog_refresh, catalog_sources  # noqa: F401  (registration side effects)
from .catalog import QUERIES

__all__ = ["QUERIES"]
