"""Operators of rasters, places, statistics, the catalog and models, as DataFrame functions."""
