"""Rows of Spark and DuckDB in one comparable form."""


def one(v):
    if v is None or type(v).__name__ in ("NAType", "NaTType"):
        return None
    if hasattr(v, "tolist") and getattr(v, "shape", ()) != ():
        return repr([one(x) for x in v.tolist()])
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        return None if v != v else str(int(v)) if v == int(v) and abs(v) < 2**52 else repr(round(v, 6))
    return str(v)


def rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted(tuple(str(one(v)) for v in r) for r in pdf[cols].astype(object).itertuples(index=False))
