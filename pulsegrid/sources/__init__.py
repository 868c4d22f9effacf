"""Readers, landing jobs and writers."""
