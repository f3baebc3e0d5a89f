"""Data-quality operators: profile, pii, validate, clean, mask, extensions."""
