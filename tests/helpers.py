import hashlib


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return bytes(v).hex()
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def same_as_oracle(df, duck, sql):
    rows = [tuple(r) for r in df.collect()]
    cur = duck.execute(sql)
    orows = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert digest(df.columns, rows) == digest(ocols, orows)
    return len(rows)
