"""Batch analytics for geolocated stations and intersections on Spark DataFrames."""
