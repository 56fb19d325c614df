"""Operators for preparing training data: sharding, mixing, classification,
deduplication, decontamination, secret scanning, chat formatting and
token-id output. Nothing else in the library imports this subpackage."""
