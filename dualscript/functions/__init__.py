"""Column -> Column building blocks (no I/O, no actions)."""
