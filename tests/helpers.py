"""Helpers that several test files share (a name of their own: every folder of
tests may have a ``conftest``)."""

SF = "/root/testdata/sf0.001"


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
