"""Registered queries: operators over tables derived from the driver data."""
