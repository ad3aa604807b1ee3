"""Marketplace analytics on Spark."""
