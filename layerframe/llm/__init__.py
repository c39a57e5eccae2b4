"""Operators for preparing training text: tokenizing, near duplicates, packing, search, filters.

Nothing outside this folder imports it; ``__spark_entry__.py`` adds its queries when it is there.
"""
