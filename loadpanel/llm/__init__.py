"""Operators for preparing text corpora, one module each.

Nothing outside this folder imports it. ``queries.all_queries`` lists the named
queries, ``queries.all_oracles`` their SQL.
"""
