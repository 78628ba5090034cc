"""Operators for preparing training text: near-duplicate and substring
removal, quality and language-model scores, sharding, fingerprints, benchmark
decontamination, license scans and packing.

Nothing outside this package imports it.  ``queries.QUERIES`` holds the named
queries, ``queries.ORACLE_SQL`` their DuckDB SQL where SQL can express them.
"""
