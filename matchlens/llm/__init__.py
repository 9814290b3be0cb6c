"""Operators of a training-data pipeline: near copies, leaks, private data, pages, rules, tokens, shards, archives."""
