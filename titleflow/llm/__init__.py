"""Training-data operators: filters, deduplication, tokenizing and scoring of a text corpus.

Nothing else in the library imports this subpackage; its queries are in
``queries.py`` and their SQL in ``oracle.py``.
"""
