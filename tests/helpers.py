"""What several test modules use."""

KEY = "key-for-tests-only"


def rows(frame):
    """Contents of a small frame as a set of tuples; copies are an error."""
    found = [tuple(r) for r in frame.collect()]
    assert len(found) == len(set(found)), "duplicate rows"
    return set(found)
