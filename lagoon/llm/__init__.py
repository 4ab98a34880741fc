"""Operators of a training-data pipeline: mixing, rules, dedup, PII, toxicity, tokens, search.

Nothing else in the package imports this folder; it may be deleted as a whole.
"""
