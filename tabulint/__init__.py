"""Profile, check and clean tables of any size with plain Spark column expressions."""
