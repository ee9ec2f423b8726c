"""Training-data operators: extraction, cleaning, classification, joins, packing and search."""
