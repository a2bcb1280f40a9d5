"""Training-data operators: WARC, sharding, deduplication, packing, licences, tokens, scoring, media, languages.

Nothing outside this subpackage imports it.  ``registry`` lists the queries and their SQL.
"""
