"""Operators over pages, regions, lines and their records."""
