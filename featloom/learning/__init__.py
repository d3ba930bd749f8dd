"""Preprocessing, tree ensembles, search and batch scoring on MLlib and DataFrames."""
