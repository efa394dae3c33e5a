from decimal import Decimal


def rows(frame):
    """Rows as tuples, decimals as their plain text, in the frame's order."""
    return [
        tuple(format(v, "f") if isinstance(v, Decimal) else v for v in row) for row in frame.collect()
    ]
