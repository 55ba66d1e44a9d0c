"""Column functions: they take columns and return columns, and work in batch and streaming."""
