"""Following a growing result tree."""

from .follow import follow_outcomes, follow_quality

__all__ = ["follow_outcomes", "follow_quality"]
