"""Where tables and specs come from, and where results are published."""
