"""Splits, fitted statistics, metrics, comparison, selection, sampling and models."""
