"""Column-level building blocks and distributed statistics."""
