"""Operators over outcome and quality tables."""

from . import logfold, outcome, planning, quality, selection, stats

__all__ = ["logfold", "outcome", "planning", "quality", "selection", "stats"]
