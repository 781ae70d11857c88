"""Text cleaning helpers (Column -> Column), all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (must equal the reference's / warehouse dialect's) ----
# Email shape accepted by the validity check.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
# Characters after which the warehouse's INITCAP starts a new word (its
# documented default delimiter set), plus all white space.
TITLE_DELIMITERS = ' []{}()/|\\<>!?@"^#$&~_,.:;*%+-'
# --------------------------------------------------------------------------

_MARK = "\u0001"
# Regex class of the delimiters: every punctuation character escaped.
_DELIM_CLASS = "([\\s" + "".join("\\" + ch for ch in TITLE_DELIMITERS if ch != " ") + "])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Trim all leading/trailing white space (tabs and newlines too), the
    warehouse's ``trim`` semantics; Spark's ``trim`` strips spaces only."""
    return F.regexp_replace(_col(c), r"^\s+|\s+$", "")


def title_case(c) -> Column:
    """Upper-case the first letter of every word and lower-case the rest,
    where a word starts after white space or punctuation.

    Spark's ``initcap`` only starts words after a space, so each delimiter is
    followed by a marker and a space, ``initcap`` runs, and the marker pair is
    removed again.
    """
    marked = F.regexp_replace(_col(c), _DELIM_CLASS, "$1" + _MARK + " ")
    return F.regexp_replace(F.initcap(marked), _MARK + " ", "")


def is_valid_email(c) -> Column:
    """True when the whole value has an email shape; null stays null. The
    pattern's final ``$`` would also match before a closing line feed."""
    return _col(c).rlike(EMAIL_PATTERN) & ~_col(c).endswith("\n")
