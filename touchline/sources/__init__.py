"""Readers: landed JSON, JSON streams, layer tables."""
