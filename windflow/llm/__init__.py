"""Operators for preparing training text: removal of copies, filters, language, counts, packing."""
