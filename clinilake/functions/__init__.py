"""Column functions: text normalisation (F7), document numbers (F6),
Spanish month text to date (D1).

All are compositions of built-in expressions, so they stay inside
whole-stage codegen and are constant-folded when applied to literals.
Every parse uses a ``try_*`` form: under ANSI mode a bad value becomes null
instead of failing the job.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spanish month names in calendar order, as they appear in the
# headers of the diagnosis spreadsheet ("ENERO 2023", "FEBRERO 2023", ...).
SPANISH_MONTHS = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO",
                  "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]

# Letters that do not decompose into a base letter plus accents,
# with their plain transliteration.
_LIGATURES = {"Æ": "AE", "Œ": "OE", "Ø": "O", "Đ": "D", "Ð": "D", "Ł": "L",
              "Þ": "TH", "ß": "SS", "ẞ": "SS", "Ħ": "H", "Ŧ": "T", "Ŋ": "N", "Ĳ": "IJ",
              "º": "o", "ª": "a"}

# Capital letters of other scripts and their Latin spelling.
_GREEK = {"Α": "A", "Β": "B", "Γ": "G", "Δ": "D", "Ε": "E", "Ζ": "Z", "Η": "E", "Θ": "Th", "Ι": "I", "Κ": "K",
          "Λ": "L", "Μ": "M", "Ν": "N", "Ξ": "X", "Ο": "O", "Π": "P", "Ρ": "R", "Σ": "S", "Τ": "T", "Υ": "U",
          "Φ": "Ph", "Χ": "Kh", "Ψ": "Ps", "Ω": "O"}
_CYRILLIC = {"А": "A", "Б": "B", "В": "V", "Г": "G", "Д": "D", "Е": "E", "Ж": "Zh", "З": "Z", "И": "I", "Й": "I",
             "К": "K", "Л": "L", "М": "M", "Н": "N", "О": "O", "П": "P", "Р": "R", "С": "S", "Т": "T", "У": "U",
             "Ф": "F", "Х": "Kh", "Ц": "Ts", "Ч": "Ch", "Ш": "Sh", "Щ": "Shch", "Ъ": "'", "Ы": "Y", "Ь": "'",
             "Э": "E", "Ю": "Iu", "Я": "Ia", "Ё": "Io", "Ђ": "Dj", "Є": "Ie", "Ѕ": "Dz", "І": "I", "Ї": "Yi",
             "Ј": "J", "Љ": "Lj", "Њ": "Nj", "Ћ": "Tsh", "Ў": "U", "Џ": "Dzh", "Ґ": "G"}
# Greek, Cyrillic and Greek Extended.
_OTHER = (range(0x0370, 0x0530), range(0x1F00, 0x2000))
_OTHER_SCRIPT = "[\\u0370-\\u052F\\u1F00-\\u1FFF]"

# Latin-1, Latin Extended-A and -B, and Latin Extended Additional.
_LATIN = (range(0x00C0, 0x0250), range(0x1E00, 0x1F00))


def _accent_table() -> tuple[str, str]:
    """Latin letters that have no other upper-case form and whose canonical
    decomposition starts with an ASCII letter, mapped to that letter."""
    src, dst = [], []
    for code in (c for block in _LATIN for c in block):
        ch = chr(code)
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and base.isascii() and base.isalpha():
            if ch == ch.upper() or len(ch.upper()) > 1:  # lower case is upper-cased before lookup
                src.append(ch)
                dst.append(base.upper())
    return "".join(src), "".join(dst)


_ACCENTED, _PLAIN = _accent_table()


def _script_table() -> tuple[dict[str, str], dict[str, str]]:
    """Letters of other scripts: those spelt in one Latin letter (or looked up as
    another letter) with it, and those spelt in several with these.

    An accented letter that the tables do not name is spelt as the base letter
    of its canonical decomposition.
    """
    named = _GREEK | _CYRILLIC
    base = {chr(c): unicodedata.normalize("NFD", chr(c))[0] for block in _OTHER for c in block if chr(c) == chr(c).upper()}
    spelt = {c: b for c, b in base.items() if b in named} | {c: c for c in named}
    several = {c: t for c, t in named.items() if len(t) > 1}
    return {c: b if b in several else named[b] for c, b in spelt.items() if c not in several}, several


_SCRIPT, _SCRIPT_SEVERAL = _script_table()
_SINGLE = {c: t for c, t in _LIGATURES.items() if len(t) == 1} | dict(zip(_ACCENTED, _PLAIN))
_SEVERAL = {c: t for c, t in _LIGATURES.items() if len(t) > 1}

# Java regex: (?U) makes \s match every Unicode space, NBSP included, as
# Python's str.strip does.
_EDGE_SPACE = r"(?U)^\s+|\s+$"
# Combining marks: what is left of letters written in decomposed form.
_MARKS = "".join(map(chr, range(0x0300, 0x0370)))


def _spelt(c: Column, single: dict[str, str], several: dict[str, str]) -> Column:
    """``c`` with letters replaced by one or by several, and marks dropped.

    One pass puts letter for letter (and drops the marks, that have none), then one
    search of the bytes each does the few letters spelt in several.  The text is
    never cut into letters: Spark's ``regexp_extract_all`` may copy the whole text for
    each match, and its maps are searched from the start.
    """
    c = F.translate(c, "".join(single) + _MARKS, "".join(single.values()))
    for letter, letters in several.items():
        c = F.replace(c, F.lit(letter), F.lit(letters))
    return c


def normalize_text(col: Column | str) -> Column:
    """Strip, upper-case and remove accents (null stays null).

    ``" Pediatría "`` -> ``"PEDIATRIA"``; ``"Ñandú"`` -> ``"NANDU"``, composed
    or decomposed; the ordinal signs become ``o`` and ``a``.  Greek and Cyrillic
    letters are spelt in Latin ones, several where need be (``"Жук"`` ->
    ``"ZhUK"``); other scripts stay as they are.
    """
    given = F.col(col) if isinstance(col, str) else col
    c = F.upper(F.regexp_replace(given, _EDGE_SPACE, ""))
    # Few texts hold letters of other scripts: the others pay one look.
    return F.when(given.rlike(_OTHER_SCRIPT), _spelt(c, _SINGLE | _SCRIPT, _SEVERAL | _SCRIPT_SEVERAL)
                  ).otherwise(_spelt(c, _SINGLE, _SEVERAL))


def document_text(col: Column | str) -> Column:
    """Document number as plain digits: ``1.23456789E9`` -> ``"1234567890"``.

    Spreadsheet readers infer numeric document columns as double; going
    through ``decimal(20,0)`` avoids the exponent (fractions round half up).
    Values that are not numbers, or do not fit 20 digits, become null.
    """
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast("decimal(20,0)").try_cast("string")


def _month_map(months: Sequence[str]) -> Column:
    if len(months) != 12:
        raise ValueError("months must name the twelve months in calendar order")
    return F.create_map(*[x for i, name in enumerate(months, start=1)
                          for x in (F.lit(name), F.lit(f"{i:02d}"))])


def clean_header(col: Column | str) -> Column:
    """Header text made comparable: every Unicode space (NBSP included) becomes
    a plain space, edges are stripped, letters upper-cased."""
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.regexp_replace(F.regexp_replace(c, r"(?U)\s", " "), r"^ +| +$", ""))


def month_text_to_date(col: Column | str, clean: bool = False,
                       months: Sequence[str] = SPANISH_MONTHS) -> Column:
    """``"ENERO 2023"`` -> ``date 2023-01-01``; anything unparseable -> null.

    The text is split on whitespace runs; the first token must be an upper-case
    Spanish month name and the second a four-digit year.  With ``clean=True``
    the text goes through :func:`clean_header` first, so ``" enero\u00a02023"``
    parses too.  ``months`` replaces the Spanish names (twelve names in
    calendar order, as written in the headers).
    """
    c = F.col(col) if isinstance(col, str) else col
    if clean:
        c = clean_header(c)
    parts = F.split(c, r"\s+")
    month = F.try_element_at(_month_map(months), F.try_element_at(parts, F.lit(1)))
    year = F.try_element_at(parts, F.lit(2))
    return F.try_to_date(F.concat(F.lit("01/"), month, F.lit("/"), year), "dd/MM/yyyy")


def month_label(col: Column | str, months: Sequence[str] = SPANISH_MONTHS) -> Column:
    """Inverse of :func:`month_text_to_date`: a date or timestamp to
    ``"<MONTH NAME> <yyyy>"``."""
    c = F.col(col) if isinstance(col, str) else col
    names = F.array(*[F.lit(m) for m in months])
    return F.concat(F.element_at(names, F.month(c)), F.lit(" "), F.date_format(c, "yyyy"))


def month_labels(year_from: int, year_to: int, months: Sequence[str] = SPANISH_MONTHS) -> list[str]:
    """Header texts for every month of the inclusive year range."""
    return [f"{m} {y}" for y in range(year_from, year_to + 1) for m in months]
