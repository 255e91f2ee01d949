"""Column functions: text cleaning, keys, geocode JSON, term extraction."""
