"""Operators for building training data at scale: near and exact de-duplication,
packing, scoring, tokenising, sharding and filtering of large text tables."""
