"""Operators of a large training-data pipeline: packing, mixing, WARC files,
chat formatting, vector search, fingerprints, quality, PII, near duplicates
and toxicity.  Nothing else in the library imports this subpackage."""
