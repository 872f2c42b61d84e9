"""Helpers of the tests, in a module of their own: a second conftest hides the first one's names."""



def rows(df, *order):
    """Rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
