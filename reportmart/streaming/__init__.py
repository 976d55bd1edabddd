"""Loads that add to what is already there."""

from .incremental import loaded_periods, new_periods

__all__ = ["loaded_periods", "new_periods"]
