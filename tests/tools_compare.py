"""Order-insensitive comparison of two result sets (floats to 9 digits)."""

import math


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(f"{v:.9g}")
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def same_rows(scols, srows, dcols, drows):
    if sorted(scols) != sorted(dcols):
        return False, f"columns {sorted(scols)} vs {sorted(dcols)}"
    a, b = _rows(scols, srows), _rows(dcols, drows)
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if x != y]
    if diff:
        return False, f"{len(diff)} rows differ, e.g. {diff[0][0]} vs {diff[0][1]}"
    return True, ""
