"""Operators that prepare training text: ten filters, encoders and joins over documents, pages and conversations."""
