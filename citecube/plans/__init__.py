"""Whole plans: star-schema build, OLAP queries, cube."""
