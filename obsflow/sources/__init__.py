"""Readers and writers of observations."""
