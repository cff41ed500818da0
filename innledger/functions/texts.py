"""Numbers as texts."""

_BITS = 56  # binary places of the fraction that are looked at as a whole number


def fixed_point(value: str) -> str:
    """SQL for a DOUBLE with two decimals, rounded half to even by its exact binary value.

    ``format_string`` rounds half up, and by the shortest decimal that stands for the
    value. Here hundredths are found with whole numbers: the fraction times 2**56 is cut to
    a BIGINT, and what is cut off decides only where the rest is exactly one half.
    """
    x = f"abs({value})"
    fraction = f"({x} - floor({x}))"
    scaled = f"({fraction} * {1 << _BITS}D)"
    whole = f"CAST(floor({scaled}) AS BIGINT)"
    hundredths = f"shiftright(100 * {whole}, {_BITS})"
    rest = f"((100 * {whole}) & {(1 << _BITS) - 1}L)"
    above = f"(({rest} - {1 << _BITS - 1}L) + 100 * ({scaled} - floor({scaled})))"
    units = f"(CAST(floor({x}) AS BIGINT) * 100 + {hundredths})"
    rounded = f"({units} + CASE WHEN {above} > 0 OR ({above} = 0 AND {units} % 2 = 1) THEN 1 ELSE 0 END)"
    sign = f"CASE WHEN {value} < 0 THEN '-' ELSE '' END"
    small = f"concat({sign}, format_string('%d.%02d', {rounded} div 100, {rounded} % 100))"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL"
        f" WHEN {x} < 4e15D THEN {small} ELSE format_string('%.2f', {value}) END"
    )
