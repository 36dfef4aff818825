"""Readers: archives, listings, curated flights, airports."""
