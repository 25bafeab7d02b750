"""Column expressions: normal forms, ordered lists, digests."""
