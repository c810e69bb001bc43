"""Imports every query module so that all queries register."""

from . import q_clean, q_features, q_market, q_models, q_sources  # noqa: F401
