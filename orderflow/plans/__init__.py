"""Whole reports and runs put together from the operators."""
