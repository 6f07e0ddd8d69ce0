"""Training-data operators: URL filters, BPE, HTML extraction, secret scans,
exact and near de-duplication, quality rules, decontamination, token counts.

Nothing else in the library imports this subpackage.
"""
