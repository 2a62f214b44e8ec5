"""Corpus analytics on Spark."""
