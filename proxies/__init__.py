"""Queries that exercise every operator on the given tables, with SQL to check them by.

The tables hold no simulation output, so each reference concept is read off a
table that has its shape (see `tables`). `QUERIES` and `ORACLES` fill as the
modules are imported.
"""

from proxies.registry import ORACLES, QUERIES
from proxies import diagnostics, grids, names, panels, series, spectra, stores, text  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
