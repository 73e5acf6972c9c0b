"""Training-data operators: dedup, quality, toxicity, secrets, mixing, tokens.

Nothing else in the library imports this subpackage.  Each operator takes a
frame with an id and a text column and works on whole texts of all its rows.
"""
