"""Comparison shared by the test modules; a name of its own, since each folder of tests has a ``conftest``."""


def same(a, b, places=6):
    """Equal rows in any order, floats to ``places``."""
    def norm(df):
        cols = sorted(df.columns)
        return sorted((tuple(round(v, places) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect()), key=str)
    left, right = norm(a), norm(b)
    assert len(left) == len(right)
    assert left == right
