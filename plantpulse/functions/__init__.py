"""Column expressions: identifiers, time, rules."""
