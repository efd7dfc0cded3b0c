"""Batch scans, the streaming file source and storage helpers."""
