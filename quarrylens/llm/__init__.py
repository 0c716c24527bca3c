"""Training-data operators: cleaning, deduplication, scoring, packing and archives of web text."""
