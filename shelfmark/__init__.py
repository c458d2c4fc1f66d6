"""Curation of research-repository records on Spark."""
