"""Layered (bronze, silver, gold) warehouse building blocks for Spark."""
