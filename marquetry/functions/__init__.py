"""Column functions. Each takes and returns a ``Column``; none is a Python UDF."""
