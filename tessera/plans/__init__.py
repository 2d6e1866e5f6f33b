"""Whole jobs: importing maps and boundaries, serving tiles, and making all tiles of a region."""
