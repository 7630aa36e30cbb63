"""Spark-native analytics for gridded scenes, run catalogs and corpora."""
