"""Operators for preparing training text: duplicates, packing, language, quality, secrets, leaks and token counts."""
