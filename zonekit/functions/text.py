"""Name normalisation used to match place names across sources.

Two levels:

* ``basic_norm`` - the reference behaviour: strip Unicode *combining* marks,
  then lower-case. On NFC text (precomposed letters) it leaves accents in.
* ``canon`` - accent, case and punctuation insensitive key: lower-case,
  strip combining marks, fold precomposed Latin letters to their base
  letter, collapse every run of characters that are no letter, mark or
  digit (of any script) into one space, trim.

Both are plain built-in expressions (``lower``/``translate``/
``regexp_replace``/``trim``) so they stay inside whole-stage codegen; the
``*_sql`` twins emit the same rule as SQL text for an ANSI engine.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accent-stripping pattern of the reference (combining
# diacritical marks block, U+0300..U+036F).
COMBINING_MARKS = "[\u0300-\u036f]"

# Letters that Unicode does not decompose but that are plain
# accented forms of an ASCII letter in the languages we meet.
_EXTRA_FOLDS = {"ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t"}

# Letters that fold to more than one ASCII letter.
_MULTI_FOLDS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}

# Everything outside this class becomes a single space in ``canon``.
NON_ALNUM_RUN = r"[^\p{L}\p{M}\p{N}]+"


def _build_fold_table(first: int = 0x00C0, last: int = 0x024F) -> tuple[str, str]:
    """Derive the precomposed-letter fold table by rule: every lower-case
    code point in Latin-1 Supplement .. Latin Extended-B whose canonical
    decomposition starts with an ASCII letter maps to that letter."""
    src, dst = [], []
    for cp in range(first, last + 1):
        ch = chr(cp)
        if ch != ch.lower():
            continue
        base = unicodedata.normalize("NFD", ch)[0]
        if base != ch and "a" <= base <= "z":
            src.append(ch)
            dst.append(base)
        elif ch in _EXTRA_FOLDS:
            src.append(ch)
            dst.append(_EXTRA_FOLDS[ch])
    return "".join(src), "".join(dst)


FOLD_FROM, FOLD_TO = _build_fold_table()


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def basic_norm(col) -> Column:
    """Reference normalisation: remove combining marks, then lower-case."""
    return F.lower(F.regexp_replace(_c(col), COMBINING_MARKS, ""))


def canon(col) -> Column:
    """Accent/case/punctuation-insensitive matching key."""
    x = F.regexp_replace(F.lower(_c(col)), COMBINING_MARKS, "")
    for src, dst in _MULTI_FOLDS.items():
        x = F.replace(x, F.lit(src), F.lit(dst))
    folded = F.translate(x, FOLD_FROM, FOLD_TO)
    return F.trim(F.regexp_replace(folded, NON_ALNUM_RUN, " "))


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def basic_norm_sql(expr: str) -> str:
    return f"lower(regexp_replace({expr}, {_sql_lit(COMBINING_MARKS)}, '', 'g'))"


def canon_sql(expr: str) -> str:
    """``canon`` as SQL text (regexp flags in the DuckDB dialect)."""
    x = f"regexp_replace(lower({expr}), {_sql_lit(COMBINING_MARKS)}, '', 'g')"
    for src, dst in _MULTI_FOLDS.items():
        x = f"replace({x}, {_sql_lit(src)}, {_sql_lit(dst)})"
    inner = f"translate({x}, {_sql_lit(FOLD_FROM)}, {_sql_lit(FOLD_TO)})"
    return f"trim(regexp_replace({inner}, {_sql_lit(NON_ALNUM_RUN)}, ' ', 'g'))"
