"""Readers and writers of the landing zone and the catalogue."""
