"""Training-data operators: near-duplicate joins, tokenisation, packing, PII, sharding.

Nothing outside this folder imports it; ``queries.py`` holds the registered
queries and their SQL.
"""
