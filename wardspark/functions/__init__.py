"""Column-level functions: everything here returns a Spark ``Column``."""
