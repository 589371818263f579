"""Readers and writers of the game, flag and prediction tables."""
