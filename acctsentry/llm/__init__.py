"""Training-data operators (line dedup, sharding, secret scans, ...).

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries only when it is present.
"""
