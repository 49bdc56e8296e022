"""Operators for preparing training corpora (documents, embeddings, pages).

Nothing outside this subpackage imports it; the registered queries are in
``queries.py``.
"""
