"""What tests compare."""


def rows(df, *columns):
    """Sorted tuples; nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted(
        (tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t]
    )
