"""What tests share."""

SF = "/root/testdata/sf0.001"


def same(df, con, sql):
    """Assert that a DataFrame and SQL give the same rows."""

    def plain(v):
        if isinstance(v, float):
            return round(v, 7)
        return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v

    cols = sorted(df.columns)
    got = sorted((tuple(map(plain, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)
    r = con.execute(sql)
    names = [d[0] for d in r.description]
    assert sorted(names) == cols
    want = sorted((tuple(plain(x[names.index(c)]) for c in cols) for x in r.fetchall()), key=repr)
    assert got == want
