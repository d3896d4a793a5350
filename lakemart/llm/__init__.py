"""Operators for preparing training text at scale.

Each module holds one operator with a general interface (DataFrame in, lazy
DataFrame out); ``queries`` binds them to the given tables and holds their SQL.
Nothing else in the library imports this package.

Common rules, unless a module says otherwise: a null text counts as empty, only
the columns named in a signature are read (extra columns, whatever their names,
are ignored or carried untouched), an empty table gives an empty result, and
rows that repeat an id are treated row by row.
"""
