"""Corpus preparation operators for language-model training data.

Nothing outside this folder imports it; ``queries.py`` holds the registered queries.
"""
