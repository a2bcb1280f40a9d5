"""Containers of documents on disk: layout, scans, typed reading, writing, catalog."""
