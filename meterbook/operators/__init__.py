"""Relational building blocks. They take column names, so they fit any schema."""
