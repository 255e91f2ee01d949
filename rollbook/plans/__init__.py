"""User-level flows composed from the operators."""
