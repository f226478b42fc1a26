"""Whole jobs: station dimension, trip mart, station-day mart, reports."""
