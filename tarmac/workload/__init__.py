"""Flight-shaped input derived from the given tables, and the queries over it."""
