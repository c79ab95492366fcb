"""Secret scans (op2), native: regular expressions, arrays and lambdas only.

Base kinds, leftmost non-overlapping per kind: ``assign`` (a keyword, ``:`` or
``=``, and a value of 6 or more characters), ``access`` (AKIA...), ``hex`` (24
or more lower-case digits). Positions come from interleaving what lies between
a pattern's matches (``split``) with the matches themselves
(``regexp_extract_all``), in code points, end exclusive.

The method adds ``entropy_hex`` and ``entropy_token`` spans: maximal runs of a
character class that are long enough are candidates (a hex run also within a
longer token run; a token run that is all hex is a hex run); a window slides over each, its
sum of c * log2(c) updated by the counts of the entering and the leaving
character alone, and the candidate is a secret if some window's Shannon entropy
reaches its class's limit. The sums are whole millionths, so results do
not depend on rounding. Candidates that the allow-list names (words, numbers,
UUIDs, paths, placeholders) or that lie inside a base span are suppressed.

No shuffle; every text is scanned whole where it lies. Runs of any length are handled:
a run is split into characters once, a step costs a window's length, and no pattern repeats
a group (the regular expression engine recurses there). Edge cases: a null or
empty text has no span; columns named like the output columns are replaced by ``scan``, and
``redact`` keeps all columns; repeated rows each get their result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonekit.llm.arrays import let, sums_before

#: kinds in the order in which spans of equal start are listed
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_token")
ASSIGN = (r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
          r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
#: candidates of the method: kind, run, window, least entropy in bits
CLASSES = {"entropy_hex": (r"[0-9A-Fa-f]+", 24, 3.0), "entropy_token": (r"[A-Za-z0-9+/_=-]+", 20, 3.8)}
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: every match lies in a match of CANDIDATE
HEX_CANDIDATE = r"[0-9A-Fa-f]{24,}"
#: rules of the allow-list: a candidate in which every pattern of the first list and none of the second is found is no secret
ALLOW = (
    ((r"^[A-Za-z_-]+$",), ()),
    ((r"^[0-9_=+/-]+$",), ()),
    # a word, then numbers and further words behind separators
    ((r"^[A-Za-z0-9_/-]+$", r"^[A-Z]?[a-z]+([^A-Za-z]|$)"), (r"[0-9][A-Za-z]", r"[_/-]([^A-Za-z]|$)")),
    ((r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",), ()),
    # a path: two components or more, each of letters, then up to four digits
    ((r"^[A-Za-z0-9_/-]+$", r"[^/]/[^/]"), (r"//", r"[0-9][A-Za-z_-]", r"[0-9]{5}", r"(^|/)[0-9]")),
    ((r"EXAMPLE|example|XXXX|xxxx",), ()),
)
_NONE = "array<struct<start:bigint,rank:int,end:bigint,kind:string,found:string>>"
MILLION = 1_000_000


def limit(window: int, bits: float) -> int:
    """A window's entropy is ``bits`` or more when its sum of c * log2(c), in millionths, is at most this."""
    return math.floor((math.log2(window) - bits) * window * MILLION)


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """The matches of one pattern as an array of spans."""
    rank = KINDS.index(kind)

    def spans(found: Column) -> Column:
        between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x).cast("long"))
        lengths = F.transform(found, lambda x: F.length(x).cast("long"))

        def place(gaps: Column) -> Column:
            return let(sums_before(F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), lengths, lambda g, m: g + m)),
                       lambda before: F.transform(found, lambda x, i: F.struct(
                           (before[i] + gaps[i]).alias("start"), F.lit(rank).alias("rank"),
                           (before[i] + gaps[i] + F.length(x)).alias("end"), F.lit(kind).alias("kind"), x.alias("found"))))
        return let(between, place)

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), 0), spans)).otherwise(F.array().cast(_NONE))


def least_sum(candidate: Column, window: int) -> Column:
    """The least sum of c * log2(c) (millionths) over the candidate's windows; it must have one."""
    gain = F.array(*[F.lit(round(c * math.log2(c) * MILLION) if c else 0).cast("long") for c in range(window + 2)])

    def over(codes: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            # the window before holds the codes from i - window on (positions from 1)
            before = F.slice(codes, F.greatest(i - window, F.lit(1)), F.least(i - 1, F.lit(window)))
            enters, leaves = codes[i - 1], F.when(i > window, codes[i - window - 1])
            up = F.size(F.filter(before, lambda c: c == enters)) - F.when(leaves == enters, 1).otherwise(0)
            down = F.size(F.filter(before, lambda c: c == leaves))
            left = F.when(leaves.isNull(), 0).otherwise(gain[down - 1] - gain[down])
            moved = (state["sum"] + left + gain[up + 1] - gain[up]).cast("long")
            return F.struct(moved.alias("sum"), F.when(i >= window, F.least(state["least"], moved)).otherwise(state["least"]).cast("long").alias("least"))

        start = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(1 << 62).cast("long").alias("least"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda state: state["least"])

    return let(F.transform(F.split(candidate, "", -1), F.ascii), over)


def allowed(candidate: Column, allow: tuple) -> Column:
    out = F.lit(False)
    for found, never in allow:
        rule = F.lit(True)
        for pattern in found:
            rule &= candidate.rlike(pattern)
        for pattern in never:
            rule &= ~candidate.rlike(pattern)
        out |= rule
    return out


def _entropy_spans(text: Column, base: Column, allow: tuple) -> Column:
    hex_run, hex_window, _ = CLASSES["entropy_hex"]

    def secrets(pattern: str, kind: str) -> Column:
        _, window, bits = CLASSES[kind]

        def secret(span: Column) -> Column:
            s = span["found"]
            inside = F.exists(base, lambda b: (b["start"] <= span["start"]) & (span["end"] <= b["end"]))
            other = s.rlike(f"^{hex_run}$") & (F.length(s) >= hex_window) if kind == "entropy_token" else F.lit(False)
            return F.when(inside | other | allowed(s, allow), F.lit(False)).otherwise(least_sum(s, window) <= limit(window, bits))

        return F.filter(_spans(text, pattern, kind), secret)

    return F.concat(secrets(HEX_CANDIDATE, "entropy_hex"), secrets(CANDIDATE, "entropy_token"))


def scan(docs: DataFrame, text_col: str = "text", allow: tuple = ALLOW) -> DataFrame:
    """Add ``base_spans`` and ``all_spans`` to every row: arrays of
    ``(start, rank, end, kind, found)`` by start, then kind. Columns of these
    names are replaced."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = F.filter(_spans(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["found"], ASSIGN, 2)) >= 6)
    base = F.array_sort(F.concat(assign, _spans(text, ACCESS, "access"), _spans(text, HEX, "hex")))
    docs = docs.drop("base_spans", "all_spans").withColumn("base_spans", base)
    # on most texts no candidate is there: the lambdas run on few rows
    added = F.when(text.rlike(CANDIDATE), _entropy_spans(text, F.col("base_spans"), allow)).otherwise(F.array().cast(_NONE))
    return docs.withColumn("all_spans", F.array_sort(F.concat(F.col("base_spans"), added)))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]", allow: tuple = ALLOW) -> DataFrame:
    """Replace every span (overlapping ones together) by ``mark``; texts without spans and all other columns stay as they are."""
    found = scan(docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text")), "text", allow)
    text = F.col("text")

    def cover(state: Column, span: Column) -> Column:
        fresh = span["start"] >= state["end"]
        kept = F.substring(text, (state["end"] + 1).cast("int"), (span["start"] - state["end"]).cast("int"))
        return F.struct(F.when(fresh, F.concat(state["parts"], F.array(kept, F.lit(mark)))).otherwise(state["parts"]).alias("parts"),
                        F.greatest(state["end"], span["end"]).alias("end"))

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("end"))
    clean = F.aggregate(F.col("all_spans"), start, cover, lambda state: F.concat(
        F.array_join(state["parts"], ""), F.substring(text, (state["end"] + 1).cast("int"), F.length(text))))
    redacted = F.when(F.size("all_spans") > 0, clean).otherwise(text)
    return found.select(*[redacted.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])


__all__ = ["scan", "redact", "listed", "least_sum", "limit", "allowed", "KINDS", "CLASSES", "CANDIDATE", "HEX_CANDIDATE", "ALLOW", "ASSIGN", "ACCESS", "HEX"]
