"""Column-level helpers shared by operators and plans."""
