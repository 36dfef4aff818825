"""Whole jobs: landing, feature building, training, scoring."""
