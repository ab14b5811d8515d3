"""Loads that continue where the last one stopped (batch high watermark)."""
