"""Column and row-level helpers."""
