"""Compositions of operators: the feature run, train/score, the query catalogue."""
