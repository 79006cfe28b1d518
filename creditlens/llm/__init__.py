"""Training-data operators: near-duplicates, joins, scans, mixing, scoring and formatting of text.

Nothing outside this package imports it.  Each operator has a module with a
general interface; ``queries`` registers the ``opN_<name>`` queries over the
given tables and their oracle SQL.
"""
