"""Column expressions: keys, labels, ratios, size bundles."""
