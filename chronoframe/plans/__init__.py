"""End-to-end plans: training tables, serving, heads, and the query catalog."""
