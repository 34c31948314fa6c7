"""Operators for preparing large text corpora; see ``queries`` for the registered ones.

Nothing outside this subpackage imports it.
"""
