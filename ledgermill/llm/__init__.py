"""Operators for training-data pipelines: search, tokens, filters, mixtures, near copies.

Nothing outside this folder imports it. Each module holds one operator; ``queries`` registers
one query per operator with its SQL.
"""
