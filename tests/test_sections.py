"""X20-X22 against a plain-Python statement of the extraction rule on golden responses."""

import re

import pytest
from pyspark.sql import functions as F

from paperflow.functions import sections as SEC


def _captures(patterns, text, flags):
    """Stripped group 1 of each candidate, None where it does not match."""
    out = []
    for p in patterns:
        m = re.search(p, text, flags)
        out.append(None if m is None else m.group(1).strip())
    return out


def _pick(caps):
    """The stated rule: first capture longer than 10 chars, else the last capture."""
    hits = [c for c in caps if c is not None]
    longer = [c for c in hits if len(c) > 10]
    return longer[0] if longer else (hits[-1] if hits else None)


def _unheader(c):
    if c is None or not c.startswith(SEC.HEADER_PREFIXES):
        return c
    m = re.search(SEC.OVERVIEW_HEADER, c, re.DOTALL)
    return c if m is None else m.group(1).strip()


def python_fields(text):
    """Brute-force statement of the extraction rule with Python's re (the source dialect):
    the raw field values before the validity check (None = nothing matched)."""
    t = text.strip()
    flags = re.DOTALL | re.IGNORECASE
    fields = {f: _pick(_captures(SEC.PATTERNS[f], t, flags)) for f in SEC.FIELDS}
    if not fields["intermediate_overview"]:
        alt = _pick([_unheader(c) for c in _captures(SEC.OVERVIEW_FALLBACKS, t, flags)])
        fields["intermediate_overview"] = alt if alt is not None else fields["intermediate_overview"]
    return fields


def python_parse(text):
    fields = python_fields(text)
    ok = all(v and len(v) >= 10 for v in fields.values())
    return fields if ok else None


GOOD = ("BEGINNER_TITLE: Robots learn to walk\n\nINTERMEDIATE_TITLE: Legged locomotion via RL\n\n"
        "BEGINNER_OVERVIEW: A robot teaches itself to walk.\n\nINTERMEDIATE_OVERVIEW: Policy gradients train gaits.\n\n"
        "BEGINNER_SUMMARY: The team let a robot practice walking many times.\n\n"
        "INTERMEDIATE_SUMMARY: We train a policy with PPO in simulation and transfer it.")

CASES = {
    "good": GOOD,
    "space_header": GOOD.replace("INTERMEDIATE_OVERVIEW:", "INTERMEDIATE OVERVIEW:"),
    "title_case_header": GOOD.replace("INTERMEDIATE_OVERVIEW:", "Intermediate Overview:"),
    "blank_line_in_last": GOOD + "\n\nSecond paragraph of the last summary.",
    "short_last_para": GOOD.replace("INTERMEDIATE_SUMMARY: ", "INTERMEDIATE_SUMMARY: Tiny.\n\n"),
    "title_9": GOOD.replace("Robots learn to walk", "Nine char"),
    "title_10": GOOD.replace("Robots learn to walk", "Ten chars!"),
    "title_11": GOOD.replace("Robots learn to walk", "Eleven char"),
    "bold": GOOD.replace("BEGINNER_TITLE:", "**BEGINNER_TITLE:**"),
    "lower": GOOD.lower(),
    "crlf": GOOD.replace("\n", "\r\n"),
    "empty": "",
    "spaces": "   \n  ",
    "swallow": GOOD.replace("BEGINNER_SUMMARY: ", ""),
    "unicode_space": GOOD.replace("\n\nINTERMEDIATE_TITLE", " \n \nINTERMEDIATE_TITLE"),
}
for f_hdr in ("BEGINNER_TITLE:", "INTERMEDIATE_TITLE:", "BEGINNER_OVERVIEW:", "INTERMEDIATE_OVERVIEW:",
              "BEGINNER_SUMMARY:", "INTERMEDIATE_SUMMARY:"):
    CASES["missing_" + f_hdr] = GOOD.replace(f_hdr, "")


def test_golden_responses(spark):
    rows = [(k, v) for k, v in CASES.items()]
    df = spark.createDataFrame(rows, "name string, response string")
    got = {r["name"]: r for r in SEC.parse_responses(df).collect()}
    for name, text in CASES.items():
        want = python_parse(text)
        r = got[name]
        assert r["is_valid"] == (want is not None), name
        if want is not None:
            assert r["sections"].asDict() == want, name


def test_valid_sections_column(spark):
    df = spark.createDataFrame([(GOOD,), ("",)], "response string")
    out = df.select(SEC.valid_sections(F.col("response")).alias("s")).collect()
    assert out[0]["s"] is not None and out[1]["s"] is None


@pytest.mark.parametrize("n", [9, 10, 11])
def test_length_thresholds(spark, n):
    text = GOOD.replace("Robots learn to walk", "x" * n)
    df = spark.createDataFrame([(text,)], "response string")
    r = SEC.parse_responses(df).collect()[0]
    assert r["is_valid"] == (n >= 10)


HEADERS = ["BEGINNER_TITLE:", "INTERMEDIATE_TITLE:", "BEGINNER_OVERVIEW:", "INTERMEDIATE_OVERVIEW:",
           "BEGINNER_SUMMARY:", "INTERMEDIATE_SUMMARY:", "INTERMEDIATE OVERVIEW:", "Intermediate Overview:",
           "Beginner Summary:"]


def _response(draw_parts):
    out = []
    for hdr, style, sep, body in draw_parts:
        h = {0: hdr, 1: hdr.lower(), 2: "**" + hdr + "**", 3: hdr.title()}[style]
        out.append(h + " " + body + sep)
    return "".join(out)


def test_random_responses_match_python(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    part = st.tuples(st.sampled_from(HEADERS), st.integers(0, 3), st.sampled_from(["\n", "\n\n", " ", "\n \n", "\r\n"]),
                     st.text(alphabet=st.sampled_from(list("abc xyz.\n") + [" ", "　"]), min_size=0, max_size=25))

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(st.lists(part, min_size=0, max_size=8), min_size=40, max_size=40))
    def run(responses):
        texts = [_response(r) for r in responses]
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, response string")
        got = {r["i"]: r for r in SEC.parse_responses(df).collect()}
        for i, t in enumerate(texts):
            assert got[i]["sections"].asDict() == python_fields(t), repr(t)
            assert got[i]["is_valid"] == (python_parse(t) is not None), repr(t)

    run()
