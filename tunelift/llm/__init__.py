"""Training-data operators: packing, near-duplicate joins, fingerprints, line and span
dedup, language identification, mixing, quality scoring and WARC archives.

Nothing outside this package imports it."""
