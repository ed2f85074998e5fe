"""Whole re-engineering jobs composed of the operators."""
