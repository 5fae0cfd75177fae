"""Preparation of training text: de-duplication, selection, mixing, sharding and encoding."""
