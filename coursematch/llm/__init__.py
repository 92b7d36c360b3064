"""Training-data operators: near-duplicates, scoring, decontamination, sharding and mixing."""
