"""Relational building blocks: surrogate keys, dimension lookups, joins,
de-duplication and routing."""
