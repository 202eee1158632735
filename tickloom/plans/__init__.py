"""Whole jobs, each as one call."""
