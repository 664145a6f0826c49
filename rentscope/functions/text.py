"""Text parsing for listings: prices, room counts, locations.

Every function returns a ``Column`` so the work stays inside whole-stage
codegen.  The semantics follow Python's ``str`` methods and ``re`` module
(the reference behaviour), which differ from Spark's defaults:

* ``strip()`` removes all Unicode whitespace, Spark ``trim`` only spaces;
* a failed regex search is ``None`` in Python but ``''`` in Spark, and
  casting ``''`` raises under ANSI mode -> always ``try_cast``/``nullif``;
* ``str.title()`` upper-cases a letter after *any* non-letter
  (``O'Connor``, ``1St``), which ``initcap`` does not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.isspace() accepts, generated from that rule
# (29 characters: ASCII controls and separators, NBSP, the Unicode spaces).
PY_SPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())  # none lies above U+3000
# Word lists of the room-count patterns (one digit, no word
# boundary: "12 br" gives 2, "2.5 bath" gives 5, as in the reference).
BEDROOM_PATTERN = r"(\d)\s*(bed|bd|br|bedroom)"
BATHROOM_PATTERN = r"(\d)\s*(bath|ba|bth|bathroom)"
# Fixed value: a state suffix, case-sensitive, anchored at the end.
STATE_SUFFIX = r",?\s*TX\s*\d*$"
CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace
    (``btrim`` over a character set: no regex, code-generated)."""
    return F.btrim(_c(x), F.lit(PY_SPACE_CHARS))


# A private-use character: marks the word starts title_case inserts.
_MARK = "\ue000"


def title_case(x) -> Column:
    """Python ``str.title()``: a cased letter is upper- (title-) cased when
    the character before it is not cased, every other letter lower-cased.

    ``initcap`` title-cases after spaces only, so a marker + space is first
    inserted at every non-cased -> cased boundary (``O'Connor``, ``1St``,
    ``Euless/Bedford``) and removed afterwards.  All code-generated (no
    lambda), and ``initcap`` applies full title-case mappings (``ß`` ->
    ``Ss``, ``ǆ`` -> ``ǅ``) exactly as Python does."""
    marked = F.regexp_replace(F.lower(_c(x)), f"(?<=[^{CASED}])(?=[{CASED}])", _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def parse_price(x) -> Column:
    """``'$1,500'`` -> 1500.  Removes ``$`` and ``,``, strips whitespace and
    accepts only a whole integer (optional sign, ``_`` between digits, as
    Python ``int()``); anything else -- ``free``, ``''``, ``1500.50`` -- is null.
    The anchored extract yields ``''`` for a non-integer, which ``try_cast``
    turns into null, so the text is scanned once."""
    s = strip_ws(F.translate(_c(x), "$,", ""))
    whole = F.regexp_extract(s, r"^([+-]?[0-9]+(?:_[0-9]+)*)$", 1)
    return F.translate(whole, "_", "").try_cast("bigint")


def _first_digit(title: Column, pattern: str) -> Column:
    d = F.regexp_extract(F.lower(title), f"(?U){pattern}", 1)
    return F.nullif(d, F.lit("")).try_cast("int")


def bedrooms_from_title(x) -> Column:
    """First single digit before bed/bd/br; else 0 if the title says studio."""
    t = _c(x)
    return F.coalesce(_first_digit(t, BEDROOM_PATTERN),
                      F.when(F.lower(t).contains("studio"), F.lit(0)))


def bathrooms_from_title(x) -> Column:
    """First single digit before bath/ba/bth."""
    return _first_digit(_c(x), BATHROOM_PATTERN)


def clean_location(x) -> Column:
    """Strip, drop a trailing ``, TX 75201`` style suffix, strip ``', '``
    characters, title-case; null or empty -> ``Unknown``."""
    s = F.btrim(F.regexp_replace(strip_ws(_c(x)), f"(?U){STATE_SUFFIX}", ""), F.lit(", "))
    return F.coalesce(F.nullif(title_case(s), F.lit("")), F.lit("Unknown"))


def city_of(x) -> Column:
    """Text before the first comma, stripped; null -> ``Unknown``."""
    c = _c(x)
    return F.coalesce(strip_ws(F.split_part(c, F.lit(","), F.lit(1))), F.lit("Unknown"))
