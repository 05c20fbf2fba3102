"""Training-data operators: tokenising, cleaning, deduplicating and sharding text corpora.

Nothing outside this subpackage imports it; it can be deleted as a whole.
"""
