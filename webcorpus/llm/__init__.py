"""Operators for preparing training data: sharding, decontamination,
near-duplicates, secrets, quality, repeated passages, chat formatting,
quality rules, packing and toxicity.  Nothing else in the library imports
this subpackage.
"""
