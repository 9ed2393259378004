"""Whole batch plans composed from the operators."""
