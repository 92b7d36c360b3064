"""Column expressions: fixed code tables, code-set predicates, string helpers."""
