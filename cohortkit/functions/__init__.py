"""Column expressions and skew-safe DataFrame building blocks."""
