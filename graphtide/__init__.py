"""Relational change feeds to property-graph tables, as Spark jobs."""
