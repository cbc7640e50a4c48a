"""Column functions: everything here stays a built-in Spark expression."""
