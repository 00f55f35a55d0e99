"""Every operator as a named query over the driver's tables, with its SQL twin where one exists."""

from holdfast.catalog import evaluation, experiment, models, profile, tables  # noqa: F401
from holdfast.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
