"""Helpers of the tests; fixtures are in conftest.py."""

import datetime as dt


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
