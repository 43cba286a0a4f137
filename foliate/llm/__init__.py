"""Training-data operators: packing, rules, extraction, deduplication, language, media and token stores.

Nothing else in foliate imports this package.
"""
