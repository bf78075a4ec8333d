"""Scans of the landing files and reads and writes of the layer tables."""
