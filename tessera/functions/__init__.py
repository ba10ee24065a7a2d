"""Column expressions (text segmentation, image checks, tokens)."""
