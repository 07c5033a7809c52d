"""Shared by the tests of the text operators."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import compare  # noqa: E402

from hourgrid.llm import queries  # noqa: E402


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def differs(spark, sf_dir, name):
    """None if a registered query gives what its SQL gives."""
    con = compare.oracle_connection(sf_dir)
    return compare.compare(spark, con, name, queries.QUERIES[name], queries.ORACLES[name], sf_dir)


def roots(pairs):
    """Smallest member of the component of each node."""
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}
