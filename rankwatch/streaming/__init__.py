"""Scoring and monitoring of batches as their files arrive."""
