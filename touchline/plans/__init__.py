"""Composite tables: bronze, silver, gold and the load order."""
