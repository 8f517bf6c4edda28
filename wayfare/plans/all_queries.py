"""Imports every module that registers queries."""

from . import lake_queries, observation_queries, quality_queries, stateful_queries, transfer_queries, write_queries  # noqa: F401
