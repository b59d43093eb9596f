"""Reading and writing match tables."""
