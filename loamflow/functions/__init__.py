"""Column-level building blocks: names, masks and quality rules."""
