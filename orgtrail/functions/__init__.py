"""Column builders: built-in expressions only, nothing here needs a UDF."""
