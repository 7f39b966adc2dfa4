"""Training-data operators: archives, quality, search, tokens, sharding, near copies,
personal data, mixing. Nothing else in the library imports this subpackage."""
