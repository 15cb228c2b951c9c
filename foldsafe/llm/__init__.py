"""Training-data operators: decontamination, quality, licences, packing, near
duplicates, exact top-k, personal data, token files, line dedup, URL filters.

Nothing else in the library imports this subpackage.
"""
