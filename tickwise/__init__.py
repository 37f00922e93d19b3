"""tickwise: Spark-native toolkit for time-stamped telemetry tables.

Joins (as-of, positional, event-window range joins), exact stratified
sampling, distributed rolling/lag windows, fit/transform encoders, Spark ML
training and evaluation, event-effect estimation and streaming scoring.
"""

from .session import build_session, checked_broadcast, cut_lineage, ensure_checkpoint_dir

__all__ = ["build_session", "checked_broadcast", "cut_lineage", "ensure_checkpoint_dir"]
