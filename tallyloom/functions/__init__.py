"""Column expressions and the small per-batch helpers behind the two Python boundaries."""
