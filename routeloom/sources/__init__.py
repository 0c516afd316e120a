"""Readers of rasters, vector layers and road extracts, and the profile."""
