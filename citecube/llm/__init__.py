"""Training-data operators: quality, search, dedup, licences, URL filters,
sharding, tokenising and packing.  Nothing outside this subpackage imports it."""
