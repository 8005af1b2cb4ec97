"""Operators for preparing language-model training corpora; nothing outside imports this package."""
