"""Scalar column expressions (bands, rounding, calendar, flags, labels)."""

from .scalars import *  # noqa: F401,F403
