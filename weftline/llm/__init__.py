"""Operators for preparing training text at corpus scale, and their queries.

Nothing outside this subpackage imports it but the pipeline and the entry, which
take `queries.queries()` and `queries.oracle_sql()` where it can be imported.
"""
