"""Whole modes composed of operators, and their result tables."""
