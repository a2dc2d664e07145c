"""Training-data operators: near-duplicates, token counts, decontamination, language-model
scores, token records, byte-pair coding, top-k search, URL filters, toxicity, sharding.

Nothing else in the library imports this subpackage.
"""
