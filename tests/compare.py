"""Order-insensitive comparison of a query with its SQL."""

import numpy as np
import pandas as pd


def rows(frame):
    out = []
    columns = sorted(frame.columns)
    for values in zip(*(frame[c].tolist() for c in columns), strict=True):
        out.append(tuple(plain(v) for v in values))
    return columns, sorted(out, key=str)


def plain(v):
    if v is None or v is pd.NA or (isinstance(v, float) and np.isnan(v)):
        return None
    if isinstance(v, (bool, np.bool_)):
        return bool(v)
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if isinstance(v, str):
        return v
    try:
        return round(float(v), 6) + 0.0
    except (TypeError, ValueError):
        return str(v)


def same(spark_frame, duck_frame):
    a, b = rows(spark_frame), rows(duck_frame)
    assert a[0] == b[0]
    assert a[1] == b[1]
