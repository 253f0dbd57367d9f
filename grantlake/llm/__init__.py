"""Training-data operators: each module holds one operator; ``registry`` has the queries over the shared tables.

Nothing outside this subpackage imports it.
"""
