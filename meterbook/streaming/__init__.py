"""Continuous processing."""
