"""Column builders for codes, names and numbers. Each takes and gives a Column, so Catalyst sees plain expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and the letters they fold to (upper-case form, then the wide form for all text).
ACCENTED = "ÁÉÍÓÚÜÑ"
FOLDED = "AEIOUUN"
ACCENTED_WIDE = "ÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÑÇÝ"
FOLDED_WIDE = "AAAAAAEEEEIIIIOOOOOUUUUNCY"


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code(c: str | Column) -> Column:
    """Code without outer blanks, upper case."""
    return F.upper(F.trim(_c(c)))


def name(c: str | Column) -> Column:
    """Name with inner white space collapsed, no outer blanks, upper case."""
    return F.upper(F.trim(F.regexp_replace(_c(c), r"\s+", " ")))


def fold_then_upper(c: str | Column) -> Column:
    """Accents folded before the case changes: lower-case accented letters keep their accent."""
    return F.upper(F.trim(F.regexp_replace(F.translate(_c(c), ACCENTED, FOLDED), r"\s+", " ")))


def upper_then_fold(c: str | Column) -> Column:
    """Case changed first, so every accent folds."""
    return F.trim(F.regexp_replace(F.translate(F.upper(_c(c)), ACCENTED, FOLDED), r"\s+", " "))


def plain_text(c: str | Column) -> Column:
    """Comparison form: no case, no accents, white space of any amount as one blank; blank becomes NULL."""
    t = F.translate(F.upper(_c(c)), ACCENTED_WIDE, FOLDED_WIDE)
    t = F.regexp_replace(t, r"[\u0300-\u036f]", "")
    t = F.trim(F.regexp_replace(t, r"[\s\u00a0]+", " "))
    return F.when(t != "", t)


def match_key(c: str | Column) -> Column:
    """Only A-Z and 0-9 of the folded upper-case form."""
    return F.regexp_replace(upper_then_fold(c), "[^A-Z0-9]+", "")


def decimal_comma(c: str | Column) -> Column:
    """Number typed with comma or point; anything else is NULL."""
    return F.regexp_replace(F.trim(_c(c)), ",", ".").try_cast("double")


def blank_to(c: str | Column, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(_c(c)), F.lit("")), F.lit(default))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """NULL where the denominator is NULL or 0."""
    d = _c(den)
    return F.when(d != 0, _c(num) / d)


def invalid_key(keys: list[str], typed: tuple[str, ...] = ()) -> Column:
    """True where a key column is NULL or, unless it is in ``typed``, blank."""
    tests = [F.col(k).isNull() if k in typed else F.col(k).isNull() | (F.trim(F.col(k)) == "") for k in keys]
    return reduce(lambda a, b: a | b, tests)


def record_hash(cols: list[str]) -> Column:
    """SHA-256 of the columns joined by a bar, NULL as empty text."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256)


def version_rank(c: str | Column) -> Column:
    """Total order of published versions as a long: TXF, then TXR, then TXn by number, all others -1."""
    v = code(c)
    n = F.regexp_extract(v, r"^TX([0-9]{1,15})$", 1)
    return F.when(v == "TXF", F.lit(4_000_000_000_000_000)).when(v == "TXR", F.lit(3_000_000_000_000_000)).when(n != "", n.try_cast("long")).otherwise(F.lit(-1)).cast("long")


def number(c: str | Column) -> Column:
    """Double with NaN as NULL."""
    x = _c(c).cast("double")
    return F.when(~F.isnan(x), x)
