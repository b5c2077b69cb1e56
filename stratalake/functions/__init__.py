"""Column expressions: payload parsing, cleaning rules and report measures."""
