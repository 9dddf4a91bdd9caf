"""Training-data operators: language ID, decontamination, licence scans,
near-duplicates, mixing, line dedup, nearest neighbours, URL filters,
sharding and toxicity.  Nothing outside this subpackage imports it."""
