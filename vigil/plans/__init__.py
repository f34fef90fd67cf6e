"""Whole jobs as lazy plans."""
