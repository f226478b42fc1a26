"""Readers: trip text files, station and area JSON, warehouse tables, driver tables."""
