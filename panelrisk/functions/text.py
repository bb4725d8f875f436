"""String expressions with Python-string semantics, built from JVM-side
Spark functions only (they stay inside whole-stage codegen)."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Letters that carry case (upper, lower, title); Python's ``str.title``
# capitalises the first cased letter after any other character.
_CASED = r"\p{Lu}\p{Ll}\p{Lt}"
# Private-use marker that tags the spaces inserted for ``initcap``.
_MARK = "\ue000"
# All characters of the Unicode property White_Space.
_BLANKS = ("\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B)))
           + "\u2028\u2029\u202f\u205f\u3000")


def py_strip(c) -> Column:
    """Strip leading/trailing whitespace of any kind (like ``str.strip``;
    Spark's ``trim`` removes spaces only).  Null stays null.  A trim of named
    characters looks at the two ends; a pattern would be tried at every character."""
    return F.btrim(as_col(c), F.lit(_BLANKS))


def py_title(c) -> Column:
    """Python ``str.title``: every cased run starts upper-case and continues
    lower-case, so ``guinea-bissau`` -> ``Guinea-Bissau`` and
    ``cote d'ivoire`` -> ``Cote D'Ivoire`` (``initcap`` alone splits on
    spaces only and gives ``Guinea-bissau``).

    A tagged space is inserted after every non-cased character, ``initcap``
    capitalises the letter that follows it, and the tags are removed again:
    three JVM string functions, no lambda, no UDF."""
    spaced = F.regexp_replace(as_col(c), rf"([^{_CASED}])", "$1" + _MARK + " ")
    return F.regexp_replace(F.initcap(spaced), _MARK + " ", "")


def contains_any(c, pattern: str, case_insensitive: bool = True) -> Column:
    """Regex search that is never null: a null input is ``False``
    (pandas ``str.contains(..., na=False)``)."""
    flag = "(?i)" if case_insensitive else ""
    return F.coalesce(as_col(c).rlike(flag + pattern), F.lit(False))


def keywords_pattern(words: Iterable[str], literal: bool = True) -> str:
    """Alternation of keywords.  ``literal`` escapes regex metacharacters;
    with ``literal=False`` the words are joined as given (pandas style)."""
    words = list(words)
    if not words:
        raise ValueError("keyword list is empty")
    return "|".join(re.escape(w) if literal else w for w in words)


def null_if_blank(c) -> Column:
    """Empty or all-whitespace text -> null (what a CSV round trip does)."""
    s = py_strip(c)
    return F.when(s == "", F.lit(None).cast("string")).otherwise(s)
