"""Column expressions; all of them stay inside Catalyst, none is a Python UDF."""
