"""Incremental versions of batch operators: additions of this engine, fed by files as they arrive."""
