"""Column functions: text forms and record codecs."""
