"""All registered queries. Importing this package fills the registry."""

from panelweave.catalog import basics, domain, modelling, series, statistics  # noqa: F401
from panelweave.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
