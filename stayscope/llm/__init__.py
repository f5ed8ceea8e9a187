"""Corpus-preparation operators for language-model training data.

Nothing outside this subpackage imports it; ``queries.QUERIES`` and
``queries.ORACLE`` are what the driver entry adds when it can be imported.
"""
