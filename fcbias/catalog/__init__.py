"""Registered queries over the test tables, each beside its check in SQL."""

from . import archive, gridding, learning, observations, operational, scoring, tables  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
