"""Readers, writers, fixed values and the mapping of raw tables onto shop tables."""
