"""Compositions of operators: whole runs, the query catalogue and its SQL oracles."""
