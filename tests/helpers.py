import math
from collections import Counter


def norm(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v if isinstance(v, (int, str, bool)) else str(v)


def assert_same(sdf, duck_result):
    cols = sdf.columns
    dcols = [d[0] for d in duck_result.description]
    assert sorted(cols) == sorted(dcols)
    perm = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in perm) for r in duck_result.fetchall()]
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    assert len(srows) == len(drows)
    assert Counter(srows) == Counter(drows)
