"""Landed files as a stream."""
