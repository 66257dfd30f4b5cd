"""Column expressions (no jobs are started here)."""
