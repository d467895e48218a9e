"""Spark-native daily subscriber marts.

``sources`` and ``sinks`` read and write tables, ``functions`` are column
expressions, ``operators`` are reusable DataFrame steps and ``plans`` are the
marts.  A mart is a plain function ``mart(inputs, as_of, ...) -> DataFrame``:
it opens no session, reads no path, and looks at no clock.
"""
