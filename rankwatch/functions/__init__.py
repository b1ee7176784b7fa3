"""Column expressions: coercion, ratios, bands, derived features."""
