"""Rows of small results as plain dictionaries."""


def as_dicts(df, *order):
    return [r.asDict(recursive=True) for r in (df.orderBy(*order) if order else df).collect()]


def by_key(df, key):
    return {r[key]: r.asDict(recursive=True) for r in df.collect()}
