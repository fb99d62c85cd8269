"""Training-data operators for text corpora: language ID, secret scans, toxicity
scores, derived web-archive records, near-duplicate joins, sampled tokenisation,
main-text extraction, exact vector search, benchmark decontamination and packing.

Nothing outside this subpackage imports it.
"""
