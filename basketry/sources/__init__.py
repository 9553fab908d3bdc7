"""Readers (text, CSV, basket lines, edge lines, pair lines, driver tables) and sinks."""
