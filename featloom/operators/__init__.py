"""Relational operators of the feature, evaluation and run-tracking workflow."""
