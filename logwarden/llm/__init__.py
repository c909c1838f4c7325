"""Operators that clean, filter, deduplicate and pack text for language-model training."""
