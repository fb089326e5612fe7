"""The registered queries: one per operator, each with the SQL that must give the same rows.

A query takes (spark, sf_dir), projects the shared tables into this library's input shapes and runs the operator
over all of it. Doubles that were computed are rounded on both sides, here and not in the library.
"""

from gridplume.registered import calendar, checks, daily, marts, storage, streams

_GROUPS = [daily, storage, marts, calendar, checks, streams]

QUERIES = {name: query for group in _GROUPS for name, query in group.QUERIES.items()}
ORACLE = {name: sql for group in _GROUPS for name, sql in group.ORACLE.items()}
