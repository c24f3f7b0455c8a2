"""Training-data operators (ten of them) and the queries that apply them.

Nothing outside this subpackage imports it; ``queries.py`` holds the query table.
"""
