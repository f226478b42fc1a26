"""Relational building blocks: joins, aggregates, spatial join, slicers."""
