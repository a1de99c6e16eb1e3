"""Operators of a training-data pipeline: near copies, mixing, packing, language, search, shards, filters."""
