"""Operators for preparing large text corpora.

Self-contained: nothing else in the library imports this subpackage.
"""
