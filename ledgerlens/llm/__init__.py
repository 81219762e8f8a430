"""Training-data operators: quality rules, deduplication, packing, scoring,
license scans, mixing, personal data.  Nothing else in the library imports
this subpackage."""
