"""The registered queries: every operator and job, run on the given tables.

``roles`` lets the tables play the banking sources, ``checks`` holds the
building blocks of the comparison SQL, the ``q_*`` modules hold the queries.
"""
