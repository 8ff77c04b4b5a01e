"""String column builders (X4 default analyser, X5, F8-F14, F17, F20, P7, P17)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Token separator of the default analyser (anything that is not a
# letter or a digit), and the numeric grammar accepted by Python's float()
# (sign, digits with optional point, exponent, inf/infinity/nan).
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
# Extra stop words for institution names.
NAME_STOP_WORDS = ["有限公司", "公司", "有限责任"]
# Keyword types (P17): a keyword containing one of these words is
# a company (type 0, symbol blanked), otherwise a bond (type 2).
COMPANY_MARKERS = ["公司", "研究院"]


def tokens(text: Column, lower: bool = True, stop_words=None) -> Column:
    """Lower-cased tokens split on non letters/digits, empties dropped,
    optional analyser stop list (never indexed, never queried).

    Runs inside whole-stage codegen (no Python); whole texts are split."""
    t = F.lower(text) if lower else text
    if stop_words:
        stops = list(stop_words)
        return F.filter(F.split(t, TOKEN_SPLIT), lambda x: (x != F.lit("")) & ~x.isin(*stops))
    return F.filter(F.split(t, TOKEN_SPLIT), lambda x: x != F.lit(""))


def is_number(term: Column) -> Column:
    """Term parses as a float (Python grammar, not Spark's cast which also
    accepts `1d`/`2f`)."""
    return term.rlike(NUMBER_PATTERN)


def strip_parentheses(s: Column) -> Column:
    """drop half- and full-width parentheses."""
    return F.translate(s, "()（）", "")


def area_prefix(name: Column) -> Column:
    """2 leading characters, 3 for 内蒙古 / 黑龙江 (characters, not bytes)."""
    return F.when(name.startswith("内蒙古") | name.startswith("黑龙江"), F.substring(name, 1, 3)) \
        .otherwise(F.substring(name, 1, 2))


def empty_to_null(s: Column) -> Column:
    """F11."""
    return F.nullif(s, F.lit(""))


def url_date(url: Column) -> Column:
    """first 8-digit run of a URL, accepted only when it starts with 20."""
    d = F.regexp_extract(url, r"(\d{8})", 1)
    return F.when(d.startswith("20"), d)


def before_bar(s: Column) -> Column:
    """text before the first `|`."""
    return F.split_part(s, F.lit("|"), F.lit(1))


def absolute_link(base: Column, href: Column) -> Column:
    """base + href without its leading `./`."""
    return F.concat(base, F.substring(href, 3, 1 << 30))


def keyword_type(keyword: Column) -> Column:
    """0 for company keywords, 2 for bonds."""
    cond = None
    for m in COMPANY_MARKERS:
        c = F.instr(keyword, m) > 0
        cond = c if cond is None else (cond | c)
    return F.when(cond, F.lit(0)).otherwise(F.lit(2))
