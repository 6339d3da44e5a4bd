"""Column expressions: term codes, course predicates and the derived-code rules."""
