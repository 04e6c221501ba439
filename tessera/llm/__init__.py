"""Training-data operators: token output, sharding, packing, joins, cleaning, mixing,
extraction, deduplication, counting and selection. Nothing else in the library imports this."""
