"""DataFrame-level operators (joins, windows, ordering, sampling, stats,
encoders, models, evaluation, causal effects)."""
