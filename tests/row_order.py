"""Order of result rows, for comparing results as lists."""


def ordered(tuples):
    """Rows smallest first, null before any value."""
    return sorted(tuples, key=lambda t: [(v is not None, v) for v in t])
