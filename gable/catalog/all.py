"""Imports every catalogue module and exposes the filled registry."""

from gable.catalog import analytics, feeds, jobs, rules, tables  # noqa: F401
from gable.catalog.registry import ENTRIES

__all__ = ["ENTRIES"]
