"""Training-data operators: near-duplicates, personal data, quality, mixing,
token output, toxicity, token counts, packing.

Nothing outside this subpackage imports it, so it can be removed as a whole.
"""
