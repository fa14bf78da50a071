"""Whole reports and pipelines built from the operators."""
