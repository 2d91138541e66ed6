"""Incremental variants: append logs and inbox folders as streams."""
