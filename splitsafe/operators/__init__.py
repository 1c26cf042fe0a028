"""DataFrame → DataFrame operators of the audit (profiling, checks, splits, fits, metrics)."""
