"""String helpers: whitespace, address parts, keyed text, label formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelle.functions._util import col_of

# Python's str.strip()/split() treat the no-break space as whitespace, Java's
# \s does not; patterns that mirror Python whitespace add it explicitly.
PY_WS = r"[\s\u00a0]"


# Characters Python's str.split() treats as separators in listing text
# (ASCII whitespace and the no-break space), mapped to a plain space.
_PY_SPACES = "\t\n\r\x0b\x0c\u00a0"


def remove_whitespace(c) -> Column:
    """Remove every Java ``\\s`` character (a no-break space is kept)."""
    return F.regexp_replace(col_of(c), r"\s+", "")


def py_strip(c) -> Column:
    """Trim leading/trailing whitespace including the no-break space."""
    return F.btrim(col_of(c), F.lit(f" {_PY_SPACES}"))


def strip_cell(c) -> Column:
    """Trim Python whitespace (incl. no-break space) from a cell that is about
    to be parsed as a number; interior whitespace is mapped to spaces, which
    a number never contains anyway. Regex-free, so cheap in a scan filter."""
    return F.trim(F.translate(col_of(c), _PY_SPACES, " " * len(_PY_SPACES)))


def first_word(c) -> Column:
    """First whitespace-separated word (empty for blank text). Plain string
    functions (translate, trim, substring_index), no regex."""
    return F.substring_index(strip_cell(c), " ", 1)


def first_token(c) -> Column:
    """First whitespace-separated word (null for blank text)."""
    return F.nullif(first_word(c), F.lit(""))


def address_city(c) -> Column:
    """Text before the first ``(``, trimmed (``Lyon 3 (69003)`` gives ``Lyon 3``)."""
    return py_strip(F.substring_index(col_of(c), "(", 1))


def address_postal_code(c) -> Column:
    """Text after the first ``(`` up to the next one, ``)`` removed, trimmed;
    null when the address has no ``(``."""
    a = col_of(c)
    inner = F.substring_index(F.substring(a, F.instr(a, "(") + 1, F.length(a)), "(", 1)
    return F.when(F.contains(a, F.lit("(")), py_strip(F.replace(inner, F.lit(")"), F.lit(""))))


def join_text(arr) -> Column:
    """Concatenate text fragments without separator and trim."""
    return py_strip(F.array_join(col_of(arr), ""))


def join_nonempty(*cols, sep: str = " ") -> Column:
    """Join the non-empty parts with ``sep`` (blank and null parts skipped)."""
    return F.concat_ws(sep, *[F.nullif(col_of(c), F.lit("")) for c in cols])


def composite_key(*cols, prefix: str = "dvf", sep: str = "_") -> Column:
    """``{prefix}_{a}_{b}``; null when any part is null."""
    parts = [F.lit(prefix)] if prefix else []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append(col_of(c).cast("string"))
    return F.concat(*parts)


def sale_description(date_col, nature_col) -> Column:
    """Templated description of an open-data sale."""
    # Fixed value: text template of the description.
    return F.format_string("Mutation du %s - %s", col_of(date_col), col_of(nature_col))


def label_join(a, b, sep: str = " - ") -> Column:
    """``a - b``; null when either side is null (not ``concat_ws``)."""
    return F.concat(col_of(a), F.lit(sep), col_of(b))


def thousands(c) -> Column:
    """Value truncated toward zero, printed with comma thousands separators."""
    return F.format_number(col_of(c).cast("bigint"), 0)


# Popup labels of the postal-code map.
POPUP_FIELDS = [
    ("Code postal", "zipcode_name"),
    ("Département", "Department"),
    ("Villes", "GroupCitys"),
]
MISSING_COLUMN = "–"


def popup_text(df, missing: str = MISSING_COLUMN):
    """HTML popup per row. A missing *column* shows a dash; a null value in a
    present column prints ``None`` as the source's string formatting does."""
    parts = []
    for label, c in POPUP_FIELDS:
        value = (F.coalesce(F.col(c).cast("string"), F.lit("None")) if c in df.columns else F.lit(missing))
        parts += [F.lit(f"<b>{label} :</b> "), value, F.lit("<br>")]
    parts += [F.lit("<b>Prix moyen :</b> "), thousands(F.col("avg_price")), F.lit(" €<br>"),
              F.lit("<b>Annonces :</b> "), F.col("nb_annonces").cast("bigint").cast("string")]
    return F.concat(*parts)
