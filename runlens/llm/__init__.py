"""Operators for preparing training data.  Nothing else in the library imports them."""

from ._store import clean_up

__all__ = ["clean_up"]
