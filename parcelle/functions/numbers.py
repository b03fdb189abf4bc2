"""Numeric column helpers (dirty-number parsing, safe ratios, exact means).

All helpers are ``Column -> Column`` built from ``pyspark.sql.functions`` so
they stay inside whole-stage codegen. Dirty input never raises: every cast is
a ``try_cast`` and every ratio a ``try_divide`` (ANSI mode stays on).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions._util import col_of, let


def try_number(c, to: str = "double") -> Column:
    """``try_cast`` a string (or number) column; malformed values become null."""
    return col_of(c).try_cast(to)


def clean_number(c, to: str = "double") -> Column:
    """Generic number cleaner: keep digits, dots and commas, comma to dot.

    Empty or null input gives null; an unparsable remainder (``1.2.3``) gives
    null instead of raising.
    """
    # an empty remainder is not a number, so try_cast alone gives the null
    # (a length guard in a CASE would evaluate the regexes twice per row)
    s = col_of(c).cast("string")
    kept = F.regexp_replace(F.regexp_replace(s, r"[^0-9.,]", ""), ",", ".")
    return kept.try_cast(to)


def clean_price_text(c, to: str = "double") -> Column:
    """Price-string cleaner: strip the euro sign, ``/m²``, spaces and nbsp,
    trim, comma to dot; empty gives null, malformed gives null."""
    s = col_of(c).cast("string")
    for token in ("\u20ac", "/m\u00b2", " ", "\u00a0"):
        s = F.replace(s, F.lit(token), F.lit(""))
    s = F.regexp_replace(s, r"^[\s\u00a0]+|[\s\u00a0]+$", "")
    s = F.replace(s, F.lit(","), F.lit("."))
    return s.try_cast(to)  # empty gives null


def digits_to_long(c) -> Column:
    """Keep ASCII digits only and read them as a whole number (null if none)."""
    return F.regexp_replace(col_of(c), r"[^0-9]", "").try_cast("bigint")  # no digits gives null


def safe_ratio(num, den) -> Column:
    """``num / den`` with a zero or null denominator giving null (never raising)."""
    return F.try_divide(col_of(num).cast("double"), F.nullif(col_of(den).cast("double"), F.lit(0.0)))


def floor_ratio(num, den) -> Column:
    """Whole price per square metre: ``floor(num / den)`` when ``den > 0``."""
    d = col_of(den).cast("double")
    return F.when(d > 0, F.floor(F.try_divide(col_of(num).cast("double"), d)).cast("double"))


def rounded_ratio(num, den, scale: int = 2) -> Column:
    """``num / den`` rounded half-even to ``scale`` decimals; null when ``den`` is 0."""
    return F.bround(safe_ratio(num, den), scale)


def nullable_int(c) -> Column:
    """Blank gives null; otherwise a strict integer parse (``3.0`` is malformed)."""
    s = F.trim(col_of(c).cast("string"))
    return F.when(F.length(s) > 0, s.try_cast("int"))


def malformed(raw, parsed) -> Column:
    """True when a non-blank raw value failed to parse (reject flag)."""
    s = F.trim(col_of(raw).cast("string"))
    return F.coalesce((F.length(s) > 0) & col_of(parsed).isNull(), F.lit(False))


def zero_if_null(c, to: str = "double") -> Column:
    """Null or unparsable becomes 0 of the requested type."""
    return F.coalesce(col_of(c).try_cast(to), F.lit(0).cast(to))


# A double is taken apart into whole numbers of 2^62, 1, 2^-62 and 2^-124. Sums of whole numbers are exact, so they
# do not change with partitioning, task retries or the order in which parts are added and taken away.
_UNIT = 2**62
LIMBS = ("u", "h", "l", "d")


def exact_limbs(c) -> list[Column]:
    """The four whole numbers of a value, null where it is not finite or is 2^124 (2e37) or more.

    Nothing is rounded for a value of 2^-72 (2e-22) or more in size; of smaller ones the bits
    below 2^-124 are cut."""
    x = col_of(c).cast("double")
    unit = F.lit(float(_UNIT))
    held = F.abs(x) < F.lit(2.0**124)
    u = F.when(F.abs(x) >= unit, (x / unit).try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    rest = x - u.cast("double") * unit
    h = rest.try_cast("bigint")
    low = (rest - h.cast("double")) * unit
    low_whole = low.try_cast("bigint")
    d = ((low - low_whole.cast("double")) * unit).try_cast("bigint")
    return [F.when(held, v) for v in (u, h, low_whole, d)]


def exact_sums(c, name: str) -> list[Column]:
    """Aggregates ``{name}_u``, ``{name}_h``, ``{name}_l``, ``{name}_d`` (exact sums) and ``{name}_n`` (how many values
    they hold). Sums of such sums are exact again, and so are differences."""
    limbs = exact_limbs(c)
    return [*[F.coalesce(F.sum(v.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")).alias(f"{name}_{k}") for k, v in zip(LIMBS, limbs, strict=True)],
            F.count(limbs[1]).alias(f"{name}_n")]


def exact_total(u, h, low, d) -> Column:
    """The double next to an exact sum (within its last place), the same whatever way the sum was put together."""
    unit = F.lit(_UNIT).cast("decimal(38,0)")

    def carried(a: Column, b: Column) -> Column:  # what of ``a`` stays below a unit, and ``b`` with the rest
        stays = F.pmod(a, unit)
        return F.struct(stays.cast("decimal(38,0)").alias("a"), (b + F.call_function("div", a - stays, unit)).cast("decimal(38,0)").alias("b"))

    def canonical(s: Column, sign: int) -> Column:
        part = lambda k: (s[k] * F.lit(sign)).cast("decimal(38,0)")
        return let(carried(part("d"), part("l")), lambda x: let(carried(x["b"], part("h")), lambda y: let(carried(y["b"], part("u")), lambda z: F.struct(
            x["a"].alias("d"), y["a"].alias("l"), z["a"].alias("h"), z["b"].alias("u")))))

    def value(s: Column) -> Column:
        double = lambda k: s[k].cast("double")
        small = double("d") * F.lit(2.0**-124) + double("l") * F.lit(2.0**-62)
        return (small + double("h")) + double("u") * F.lit(2.0**62)

    sums = F.struct(*[col_of(c).cast("decimal(38,0)").alias(k) for k, c in zip(("u", "h", "l", "d"), (u, h, low, d), strict=True)])
    return let(sums, lambda s: let(canonical(s, 1), lambda p: F.when(p["u"] >= 0, value(p)).otherwise(-let(canonical(s, -1), value))))


def exact_mean(name: str, of=F.sum) -> Column:
    """Mean of the values of ``exact_sums``; ``of`` adds partial sums up (``F.col`` where they are whole)."""
    return F.try_divide(exact_total(*[of(f"{name}_{k}") for k in LIMBS]), of(f"{name}_n").cast("double"))


def exact_avg(c) -> Column:
    """Mean of the values that ``exact_limbs`` takes, as double; null without any."""
    limbs = [F.coalesce(F.sum(v.cast("decimal(28,0)")), F.lit(0).cast("decimal(38,0)")) for v in exact_limbs(c)]
    return F.try_divide(exact_total(*limbs), F.count(exact_limbs(c)[1]).cast("double"))


def stable_round(c, decimals: int = 4, snap_bits: int = 24) -> Column:
    """Round an aggregated double to ``decimals`` places reproducibly.

    A floating sum differs in its last bits with summation order (partitioning,
    retries, another engine), and ``round`` can then fall on either side of a
    decimal tie. The value is first snapped to a binary grid of
    ``2**-snap_bits`` (which absorbs that noise), then rounded half-up with
    plain IEEE arithmetic, so every evaluation gives the same double. Values
    that are too large for the grid (``2**28`` and more, infinities) are kept.
    """
    q = float(2 ** snap_bits)
    p = float(10 ** decimals)
    snapped = F.floor(col_of(c) * q + 0.5) / q
    return F.when(F.abs(col_of(c)) < float(2 ** 28), F.floor(snapped * p + 0.5) / p).otherwise(col_of(c))
