"""Column expressions, all built from Spark's own functions.

They take SQL expressions as text, so each is handed to Spark as one piece; building the
same expression call by call from Python takes longer than many of the queries.
"""
