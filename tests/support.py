"""Helpers that tests import by name; fixtures are in conftest."""

SF = "/root/testdata/sf0.001"


def rows(frame, *columns):
    """Rows as a sorted list of tuples, nulls last."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
