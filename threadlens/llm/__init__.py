"""Operators for building training corpora: decontamination, quality, PII,
extraction, mixing, licence and secret scans, similarity join, language id
and sharding.  Nothing else in the package imports this subpackage."""
