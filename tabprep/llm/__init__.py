"""Training-data operators over whole text corpora (see the README section).

Nothing outside this subpackage imports it; ``queries.py`` holds the
registered queries and their SQL.
"""
