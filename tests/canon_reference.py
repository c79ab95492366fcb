"""Independent Python reference for ``canon`` (used by the property tests)."""

import re
import unicodedata

# Independent reference for canon: Unicode canonical decomposition (NFD) of
# Latin letters, drop combining diacritical marks, lower-case, collapse runs of
# what is no letter, mark or digit of any script into one space. Letters with no
# canonical decomposition that canon folds on purpose are mapped the same way here.
SPECIAL = {"ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t",
           "ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}
LATIN = [chr(c) for c in list(range(0x20, 0x7F)) + list(range(0xC0, 0x180))
         if unicodedata.decomposition(chr(c)) == "" or not unicodedata.decomposition(chr(c)).startswith("<")]


def py_canon(s: str) -> str:
    s = "".join(SPECIAL.get(ch, ch) for ch in s.lower())
    s = "".join(unicodedata.normalize("NFD", ch) if ch < "\u0250" else ch for ch in s)
    s = "".join(ch for ch in s if not "\u0300" <= ch <= "\u036f")
    s = "".join(SPECIAL.get(ch, ch) for ch in s)
    s = "".join(ch if unicodedata.category(ch)[0] in "LMN" else " " for ch in s)
    return re.sub(" +", " ", s).strip()
