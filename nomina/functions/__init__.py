"""Column-level building blocks: text clean-up, similarity, markup, encodings."""
