"""Compositions of operators: train, evaluate, score, monitor, profile."""
