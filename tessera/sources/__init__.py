"""Snapshots and registries."""
