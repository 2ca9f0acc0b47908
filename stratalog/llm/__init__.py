"""Operators for preparing language-model training corpora.

Nothing else in the library imports this subpackage.
"""
