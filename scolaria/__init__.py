"""School analytics as PySpark DataFrame plans.

``sources`` read the school tables, ``functions`` build Column expressions, ``operators`` turn
frames into frames, ``plans`` hold the named queries.  Nothing here collects a table: every query
returns a lazy DataFrame.
"""
