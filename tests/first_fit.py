"""Plain sequential first-fit, written from the rule, as the election's reference."""


def first_fit_reference(order: list[int], adjacent) -> dict[int, int]:
    """Plain sequential first-fit, written from the rule above."""
    leaders: list[int] = []
    out: dict[int, int] = {}
    for x in sorted(order):
        hit = next((ld for ld in leaders if adjacent(ld, x)), None)
        if hit is None:
            leaders.append(x)
            out[x] = x
        else:
            out[x] = hit
    return out
