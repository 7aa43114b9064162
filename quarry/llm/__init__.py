"""Operators for preparing training text: quality rules, URL filters,
subword sampling, WARC, near-duplicates, language identification, vector
search, token counts, source mixing, line dedup, conversation repair,
token alignment and substring dedup.

Nothing outside this package imports it.
"""
