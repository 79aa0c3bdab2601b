"""Query parameters from a recorded parameter file.

A parameter file has one line per query: the query number, then its
substitution values, separated by tabs. ``read_params`` turns such a file
into keyword arguments for :mod:`dssforge.plans.queries`, so a recorded
parameter set can be replayed as is. The file is a few lines of
configuration and is read on the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from dssforge.plans import queries as Q
from dssforge.sources.tables import Catalog


def _nums(xs):
    return tuple(int(x) for x in xs)


# query number -> (function, values -> kwargs)
SIGNATURES: dict[int, tuple[Callable, Callable[[list[str]], dict]]] = {
    1: (Q.q01, lambda v: {"days": int(v[0])}),
    2: (Q.q02, lambda v: {"size": int(v[0]), "type_suffix": v[1], "region": v[2]}),
    3: (Q.q03, lambda v: {"segment": v[0], "day": v[1]}),
    4: (Q.q04, lambda v: {"day": v[0]}),
    5: (Q.q05, lambda v: {"region": v[0], "day": v[1]}),
    6: (Q.q06, lambda v: {"day": v[0], "discount": float(v[1]), "quantity": int(v[2])}),
    7: (Q.q07, lambda v: {"nation1": v[0], "nation2": v[1]}),
    8: (Q.q08, lambda v: {"nation": v[0], "region": v[1], "ptype": v[2]}),
    9: (Q.q09, lambda v: {"color": v[0]}),
    10: (Q.q10, lambda v: {"day": v[0]}),
    11: (Q.q11, lambda v: {"nation": v[0], "fraction": v[1]}),
    12: (Q.q12, lambda v: {"mode1": v[0], "mode2": v[1], "day": v[2]}),
    13: (Q.q13, lambda v: {"word1": v[0], "word2": v[1]}),
    14: (Q.q14, lambda v: {"day": v[0]}),
    15: (Q.q15, lambda v: {"day": v[0]}),
    16: (Q.q16, lambda v: {"brand": v[0], "type_prefix": v[1], "sizes": _nums(v[2:10])}),
    17: (Q.q17, lambda v: {"brand": v[0], "container": v[1]}),
    18: (Q.q18, lambda v: {"quantity": int(v[0])}),
    19: (Q.q19, lambda v: {"brands": tuple(v[0:3]), "quantities": _nums(v[3:6])}),
    20: (Q.q20, lambda v: {"color": v[0], "day": v[1], "nation": v[2]}),
    21: (Q.q21, lambda v: {"nation": v[0]}),
    22: (Q.q22, lambda v: {"codes": tuple(v[0:7])}),
}


def parse_params(text: str) -> dict[int, dict]:
    """Keyword arguments per query number from the text of a parameter file."""
    out = {}
    for line in text.splitlines():
        fields = [f for f in line.rstrip("\n").split("\t")]
        if not fields or not fields[0].strip():
            continue
        n = int(fields[0])
        out[n] = SIGNATURES[n][1]([f.strip() for f in fields[1:]])
    return out


def read_params(path: str) -> dict[int, dict]:
    with open(path) as f:
        return parse_params(f.read())


def run_with_params(cat: Catalog, params: dict[int, dict]) -> dict[int, DataFrame]:
    """Each query with its recorded parameters, as lazy DataFrames."""
    return {n: SIGNATURES[n][0](cat, **kw) for n, kw in sorted(params.items())}
