"""Operators of a training-data pipeline: near copies, repeats, toxicity, personal data, tokens, packing, search.

Nothing else in the library imports this subpackage.
"""
