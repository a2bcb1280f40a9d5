"""Containers as streams."""
