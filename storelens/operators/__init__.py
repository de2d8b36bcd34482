"""Relational building blocks Spark has no single call for."""
