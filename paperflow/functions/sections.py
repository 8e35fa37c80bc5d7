"""Section extraction from a model response (X20-X22) as Spark regex expressions.

Per field the candidates are tried in order: the first whose (stripped) capture is
longer than 10 characters wins; otherwise the capture of the last candidate that
matched at all is kept, even if short or empty. The intermediate overview has a
second round of candidates when the first round leaves it empty. A response is
valid only if all six fields are at least 10 characters long.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperflow.functions.text import PY_SPACE, strip_ws

FIELDS = ("beginner_title", "intermediate_title", "beginner_overview",
          "intermediate_overview", "beginner_summary", "intermediate_summary")

# The source application's ordered candidate patterns per field, matched
# case-insensitively with '.' spanning newlines.
PATTERNS = {
    "beginner_title": [
        r"BEGINNER_TITLE:\s*(.*?)(?=\n\s*INTERMEDIATE_TITLE:|$)",
        r"BEGINNER_TITLE:\s*(.*?)(?=\n\n|\nINTERMEDIATE)",
        r"BEGINNER_TITLE:\s*(.*?)(?=INTERMEDIATE_TITLE:)",
        r"BEGINNER_TITLE:\s*(.*?)(?=\n)",
    ],
    "intermediate_title": [
        r"INTERMEDIATE_TITLE:\s*(.*?)(?=\n\s*BEGINNER_OVERVIEW:|$)",
        r"INTERMEDIATE_TITLE:\s*(.*?)(?=\n\n|\nBEGINNER_OVERVIEW)",
        r"INTERMEDIATE_TITLE:\s*(.*?)(?=BEGINNER_OVERVIEW:)",
        r"INTERMEDIATE_TITLE:\s*(.*?)(?=\n)",
    ],
    "beginner_overview": [
        r"BEGINNER_OVERVIEW:\s*(.*?)(?=\n\s*INTERMEDIATE_OVERVIEW:|$)",
        r"BEGINNER_OVERVIEW:\s*(.*?)(?=\n\n|\nINTERMEDIATE_OVERVIEW)",
        r"BEGINNER_OVERVIEW:\s*(.*?)(?=INTERMEDIATE_OVERVIEW:)",
        r"BEGINNER_OVERVIEW:\s*(.*?)(?=\n)",
    ],
    "intermediate_overview": [
        r"INTERMEDIATE_OVERVIEW:\s*(.*?)(?=\n\s*BEGINNER_SUMMARY:|$)",
        r"INTERMEDIATE_OVERVIEW:\s*(.*?)(?=\n\n|\nBEGINNER_SUMMARY)",
        r"INTERMEDIATE_OVERVIEW:\s*(.*?)(?=BEGINNER_SUMMARY:)",
        r"INTERMEDIATE_OVERVIEW:\s*(.*?)(?=\n)",
        r"INTERMEDIATE OVERVIEW:\s*(.*?)(?=\n\s*BEGINNER_SUMMARY:|$)",
        r"Intermediate Overview:\s*(.*?)(?=\n\s*BEGINNER_SUMMARY:|$)",
    ],
    "beginner_summary": [
        r"BEGINNER_SUMMARY:\s*(.*?)(?=\n\s*INTERMEDIATE_SUMMARY:|$)",
        r"BEGINNER_SUMMARY:\s*(.*?)(?=\n\n|\nINTERMEDIATE_SUMMARY)",
        r"BEGINNER_SUMMARY:\s*(.*?)(?=INTERMEDIATE_SUMMARY:)",
        r"BEGINNER_SUMMARY:\s*(.*?)(?=\n\s*INTERMEDIATE)",
    ],
    "intermediate_summary": [
        r"INTERMEDIATE_SUMMARY:\s*(.*?)(?:\n\n|$)",
        r"INTERMEDIATE_SUMMARY:\s*(.*?)$",
        r"INTERMEDIATE_SUMMARY:\s*(.*)",
    ],
}
# Second-round candidates for the intermediate overview, and the
# header pattern stripped from a capture that starts with "INTERMEDIATE"/"Intermediate"
# (that strip is case-sensitive).
OVERVIEW_FALLBACKS = [
    r"(?:INTERMEDIATE_OVERVIEW|INTERMEDIATE OVERVIEW|Intermediate Overview):\s*(.*?)(?=\n\s*(?:BEGINNER_SUMMARY|Beginner Summary)|$)",
    r"(?:INTERMEDIATE_OVERVIEW|INTERMEDIATE OVERVIEW|Intermediate Overview):\s*(.*?)(?=\n)",
    r"BEGINNER_OVERVIEW:.*?\n\s*(.*?)(?=\n\s*(?:BEGINNER_SUMMARY|Beginner Summary))",
]
OVERVIEW_HEADER = r"(?:INTERMEDIATE_OVERVIEW|INTERMEDIATE OVERVIEW|Intermediate Overview):\s*(.*)"
HEADER_PREFIXES = ("INTERMEDIATE", "Intermediate")
EARLY_STOP_LEN = 10   # a capture longer than this ends the search for a field
MIN_FIELD_LEN = 10    # every field must be at least this long

# Java flags: s = dot-all, i = case-insensitive, u = Unicode case folding (as Python's
# IGNORECASE on str), d = only \n ends a line (so $ behaves like Python's).
_FLAGS = "(?siud)"
_FLAGS_CASE = "(?sd)"


def _fold(cands: list[tuple[Column, Column]]) -> Column:
    """First long capture, else the capture of the last candidate that matched."""
    first_long = [F.when(m & (F.char_length(x) > EARLY_STOP_LEN), x) for m, x in cands]
    last_hit = [F.when(m, x) for m, x in reversed(cands)]
    return F.coalesce(*first_long, *last_hit)


def java_pattern(pat: str) -> str:
    """Python's \\s (str patterns) in Java regex terms."""
    return pat.replace("\\s", PY_SPACE)


def _cand(t: Column, pat: str, flags: str = _FLAGS) -> tuple[Column, Column]:
    j = flags + java_pattern(pat)
    return t.rlike(j), strip_ws(F.regexp_extract(t, j, 1))


def _strip_header(x: Column) -> Column:
    starts = x.startswith(HEADER_PREFIXES[0]) | x.startswith(HEADER_PREFIXES[1])
    j = _FLAGS_CASE + java_pattern(OVERVIEW_HEADER)
    return F.when(starts & x.rlike(j), strip_ws(F.regexp_extract(x, j, 1))).otherwise(x)


def extract_sections(response) -> Column:
    """Struct of the six fields (NULL where nothing matched)."""
    t = strip_ws(F.col(response) if isinstance(response, str) else response)
    out = {}
    for f in FIELDS:
        out[f] = _fold([_cand(t, p) for p in PATTERNS[f]])
    first = out["intermediate_overview"]
    alts = []
    for p in OVERVIEW_FALLBACKS:
        m, x = _cand(t, p)
        alts.append((m, _strip_header(x)))
    out["intermediate_overview"] = F.when(first.isNull() | (first == ""), F.coalesce(_fold(alts), first)).otherwise(first)
    return F.struct(*[out[f].alias(f) for f in FIELDS])


def sections_valid(sections: Column) -> Column:
    """All six present and at least 10 characters."""
    ok = F.lit(True)
    for f in FIELDS:
        ok = ok & F.coalesce(F.char_length(sections[f]) >= MIN_FIELD_LEN, F.lit(False))
    return ok


def valid_sections(response) -> Column:
    """The parsed struct when valid, else NULL (all-or-nothing)."""
    s = extract_sections(response)
    return F.when(sections_valid(s), s)


def _grab(t: Column, pat: str, flags: str = _FLAGS) -> Column:
    """Group 1 of every match; an empty array means no match (one scan per candidate)."""
    return F.regexp_extract_all(t, F.lit(flags + java_pattern(pat)), 1)


def _hit(arr: Column) -> tuple[Column, Column]:
    return F.coalesce(F.size(arr) > 0, F.lit(False)), strip_ws(F.get(arr, 0))


def parse_responses(df, response: str = "response", out: str = "sections"):
    """Adds the parsed struct and ``is_valid``.

    Staged projections keep each generated method small, and later candidates are
    only evaluated for rows where the first candidate of that field did not already
    give a long capture (``CASE WHEN`` evaluates its branch lazily), so a well-formed
    response costs one regex scan per field.
    """
    keep = [c for c in df.columns if c != response]
    t = F.col("_resp")
    s0 = df.select(*keep, strip_ws(F.col(response)).alias("_resp"))
    s1 = s0.select(*keep, "_resp", *[_grab(t, PATTERNS[f][0]).alias(f"_a{fi}_0") for fi, f in enumerate(FIELDS)])
    firsts = []
    for fi, _ in enumerate(FIELDS):
        m, x = _hit(F.col(f"_a{fi}_0"))
        firsts += [m.alias(f"_m{fi}_0"), x.alias(f"_x{fi}_0")]
    s2 = s1.select(*keep, "_resp", *firsts)
    later = []
    for fi, f in enumerate(FIELDS):
        done = F.col(f"_m{fi}_0") & (F.char_length(F.col(f"_x{fi}_0")) > EARLY_STOP_LEN)
        for pi in range(1, len(PATTERNS[f])):
            later.append(F.when(~done, _grab(t, PATTERNS[f][pi])).alias(f"_a{fi}_{pi}"))
    prior = [F.col(f"_m{fi}_0") for fi in range(len(FIELDS))] + [F.col(f"_x{fi}_0") for fi in range(len(FIELDS))]
    s3 = s2.select(*keep, "_resp", *prior, *later)
    cols, folds = [], {}
    for fi, f in enumerate(FIELDS):
        refs = [(F.col(f"_m{fi}_0"), F.col(f"_x{fi}_0"))]
        for pi in range(1, len(PATTERNS[f])):
            m, x = _hit(F.col(f"_a{fi}_{pi}"))
            cols += [m.alias(f"_m{fi}_{pi}"), x.alias(f"_x{fi}_{pi}")]
            refs.append((F.col(f"_m{fi}_{pi}"), F.col(f"_x{fi}_{pi}")))
        folds[f] = _fold(refs)
    s4 = s3.select(*keep, "_resp", *prior, *cols)
    s5 = s4.select(*keep, "_resp", *[folds[f].alias(f) for f in FIELDS])
    io = F.col("intermediate_overview")
    need = io.isNull() | (io == "")
    s6 = s5.select(*keep, *FIELDS, *[F.when(need, _grab(t, p)).alias(f"_alt{ai}")
                                     for ai, p in enumerate(OVERVIEW_FALLBACKS)])
    alt_cols, alt_refs = [], []
    for ai in range(len(OVERVIEW_FALLBACKS)):
        m, x = _hit(F.col(f"_alt{ai}"))
        alt_cols += [m.alias(f"_am{ai}"), _strip_header(x).alias(f"_ax{ai}")]
        alt_refs.append((F.col(f"_am{ai}"), F.col(f"_ax{ai}")))
    s7 = s6.select(*keep, *FIELDS, *alt_cols)
    fixed = F.when(need, F.coalesce(_fold(alt_refs), io)).otherwise(io)
    parsed = s7.select(*keep, F.struct(*[(fixed if f == "intermediate_overview" else F.col(f)).alias(f)
                                         for f in FIELDS]).alias(out))
    return parsed.withColumn("is_valid", sections_valid(F.col(out)))
