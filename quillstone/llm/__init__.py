"""Training-data operators. Nothing outside this package imports it.

``registry`` holds the queries and their SQL.
"""
