"""Readers of corpora and CSV sources, and the versioned store."""
