"""Scans, stored layers and the published replica."""
