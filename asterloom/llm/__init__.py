"""Training-data operators: near copies, repeats, filters, language, tokens."""
