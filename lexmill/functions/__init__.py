"""Column expressions over texts and keys."""
