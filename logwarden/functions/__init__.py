"""Column expressions: no job is run by anything in this package."""
