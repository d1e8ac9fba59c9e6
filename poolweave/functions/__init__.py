"""Column expressions and plan-time rules on column names."""
