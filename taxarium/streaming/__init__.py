"""Releases that arrive file by file."""
