"""Operators for preparing large training corpora: sharding, de-duplication, fingerprints, mixing,
quality scoring, packing and token files. Nothing else in the library imports this subpackage."""
