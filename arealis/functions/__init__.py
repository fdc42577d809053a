"""Column builders: cleaning, text keys, uncertainty."""
