"""Scenes as they arrive."""
