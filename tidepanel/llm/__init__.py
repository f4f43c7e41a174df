"""Training-data operators: tokens, packing, language and quality models, near duplicates, decontamination, PII.

Nothing else in the library imports this subpackage; its queries are listed in ``queries.py``.
"""
