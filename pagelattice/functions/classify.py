"""Kinds of pages and groups of topics by their words; the first rule that holds decides."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pagelattice.functions.text import PARAMETER_ID, let, word_count

# Groups and the words that name them, in order.
GROUPS = (
    ("tuning/velocity", ("velocity", "speed loop")),
    ("tuning/position", ("position loop", "positioning", "pulse", "electronic gear")),
    ("tuning/current", ("torque", "current loop", "current limit")),
    ("motion/homing", ("homing", "origin return", "home return")),
    ("communication", ("modbus", "communication", "baud", "station no", "slave id")),
    ("diagnostics", ("fault", "alarm", "diagnostic", "error code")),
    ("io/digital_inputs", ("input terminal", "digital input", "x0", "x1")),
    ("io/digital_outputs", ("output terminal", "digital output", "y0", "y1")),
    ("protection", ("protection", "overvoltage", "overcurrent", "limit")),
    ("motor", ("motor", "encoder", "pole", "rated")),
    ("installation", ("installation", "mounting", "dimension", "clearance")),
    ("wiring", ("wiring", "connector", "pin", "terminal", "cn1", "cn2", "cn3")),
    ("commissioning", ("trial run", "commissioning", "jog", "test run")),
    ("tuning", ("gain", "tuning", "pid", "filter", "bandwidth")),
)
# Kinds of pages and their words, in order; a kind with True needs a table.
KINDS = (
    ("table_of_contents", False, ("table of contents",), r"\.\.\.\s*\d+\b"),
    ("revision_history", False, ("revision history", "change history"), None),
    ("appendix", False, ("appendix", "annex"), None),
    ("fault_code_table", True, ("fault code", "alarm code", "error code"), None),
    ("parameter_table", True, ("parameter",), "(?i)" + PARAMETER_ID),
    ("wiring_diagram", False, ("wiring diagram", "terminal wiring", "connection diagram"), None),
    ("block_diagram", False, ("block diagram", "control block", "signal flow"), None),
    ("specifications", False, ("specification", "rated", "dimension"), None),
)
SAFETY = ("danger", "warning", "caution")
# The kinds of pages that become topic files.
TOPIC_KINDS = ("narrative_knowledge", "safety_warning", "wiring_diagram", "block_diagram", "specifications", "fault_code_table")


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    out = F.contains(text, F.lit(words[0]))
    for w in words[1:]:
        out = out | F.contains(text, F.lit(w))
    return out


def has_table(html: Column) -> Column:
    return F.contains(F.lower(html), F.lit("<table"))


def group_of(text: Column) -> Column:
    """The group of a text, null if no word of any is in it. Parts of words count."""

    def of(t: Column) -> Column:
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, words in GROUPS:
            out = out.when(has_any(t, words), name)
        return out

    return let(F.lower(text), of)


def content_type(text: Column, html: Column) -> Column:
    """The kind of a page by its cleaned text and its markup."""

    def of(x: Column) -> Column:
        t, words = x["t"], x["words"]
        out = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, table, named, pattern in KINDS:
            rule = has_any(t, named) if pattern is None else has_any(t, named) | t.rlike(pattern)
            out = out.when(x["table"] & rule if table else rule, name)
        return out.when(has_any(t, SAFETY) & (words < 200), "safety_warning").when(words < 15, "cover_page").otherwise("narrative_knowledge")

    return let(F.struct(F.lower(text).alias("t"), has_table(html).alias("table"), word_count(text).alias("words")), of)
