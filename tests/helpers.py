import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def canon(pdf):
    """Column names sorted, rows as sorted tuples, floats to 6 decimals, NaN as None."""
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    key = lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t)
    return cols, sorted(rows, key=key)
