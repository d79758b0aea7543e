"""The rule set used by the registered jobs on the driver's ``documents`` table.

Rules vote ``toxic`` or ``low_quality``; one negative rule marks licence boilerplate as not relevant.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from labelkiln.operators import rules as R

# Keyword lists of the rules (chosen from the driver data, not from the reference).
TOXIC_WORDS = ["trash", "idiot", "clown", "scum", "worthless", "moron", "pathetic", "loser",
               "disgusting", "stupid"]
BOILERPLATE_WORDS = ["released under", "all rights reserved", "copyright"]
DECORATION = r"[!#*%@$~^&]{2}"
SHOUTING = r"\p{Lu}{6}"
SHORT_CHARS = 120

CLASSES = ["clean", "low_quality", "toxic"]


def document_rules() -> list[R.LF]:
    return [
        R.keyword_lf("lf_toxic", "toxic", TOXIC_WORDS),
        R.regex_lf("lf_decor", "low_quality", DECORATION),
        R.regex_lf("lf_shout", "low_quality", SHOUTING),
        R.column_lf("lf_short", "low_quality", lambda: F.col("n_chars") < SHORT_CHARS, f"n_chars < {SHORT_CHARS}"),
        R.negative_lf("lf_boilerplate", BOILERPLATE_WORDS),
    ]


def positive_rules() -> list[R.LF]:
    """The rules without the negative one (for label-matrix and label-model jobs)."""
    return [lf for lf in document_rules() if lf.label != R.NONE]


def topic_rules() -> list[R.LF | R.ListLF]:
    """One rule that returns several labels beside rules that return one."""
    return [R.topics_lf("lf_topics", {"toxic": TOXIC_WORDS, "boilerplate": BOILERPLATE_WORDS}), *positive_rules()]
