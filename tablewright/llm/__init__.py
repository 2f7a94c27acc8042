"""Operators that prepare text collections for language-model training. Nothing outside imports this package."""
