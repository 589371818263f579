"""Whole jobs: preparing data, scoring, experiments, and the catalogue of checked queries."""
