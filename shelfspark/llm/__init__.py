"""Operators for preparing training text: licence scans, fingerprints, packing,
line dedup, sharding, quality rules, repeated-window removal, token counts,
n-gram joins, sentence-piece coding, Merkle manifests, personal data and centroid clustering.

Nothing else in the library imports this subpackage. The registered queries
and their SQL are in ``shelfspark.llm.queries``.
"""
