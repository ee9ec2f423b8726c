"""Column-name cleaning.

Two rules exist: the landing rule (spaces and dashes to underscores, lower
case, brackets dropped, quotes dropped when the file is quoted) and the stage
rule (snake case from title case, then an underscore before a trailing
keyword). Each rule is given as a plain Python function, used on headers on
the driver, and as a Column expression, used when the names themselves are
data (a spec, a profile).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped from landing names, and the trailing
# keywords that get an underscore in stage names, applied in this order.
LANDING_DROPPED_CHARS = ["(", ")", "[", "]"]
STAGE_KEYWORDS = ["id", "cd", "code", "num", "flag", "desc", "name", "amt", "qty", "price"]


def landing_name(name: str, quoted: bool = False) -> str:
    """Landing column name of a header cell (P1, and P2 when quoted)."""
    if quoted:
        name = name.replace('"', "")
    name = name.replace(" ", "_").replace("-", "_").lower()
    for ch in LANDING_DROPPED_CHARS:
        name = name.replace(ch, "")
    return name


def landing_name_col(c: Column, quoted: bool = False) -> Column:
    if quoted:
        c = F.replace(c, F.lit('"'), F.lit(""))
    c = F.lower(F.translate(c, " -", "__"))
    return F.translate(c, "".join(LANDING_DROPPED_CHARS), "")


# Title case to snake case: a lower-case letter or digit followed by an upper
# case letter gets an underscore, and so does the last capital of a capital
# run that starts a new word ("HTTPServer" -> "HTTP_Server").
_LOWER_UPPER = r"([a-z0-9])([A-Z])"
_UPPER_RUN = r"([A-Z]+)([A-Z][a-z])"
_NON_ALNUM = r"[^a-z0-9]+"


def _snake(name: str) -> str:
    name = re.sub(_UPPER_RUN, r"\1_\2", name)
    name = re.sub(_LOWER_UPPER, r"\1_\2", name)
    name = re.sub(_NON_ALNUM, "_", name.lower())
    return name.strip("_")


def stage_name(name: str) -> str:
    """Stage column name (P3): snake case, then keyword suffix split."""
    name = _snake(name)
    for kw in STAGE_KEYWORDS:
        if name.endswith(kw) and len(name) > len(kw) and not name.endswith("_" + kw):
            name = name[: -len(kw)] + "_" + kw
    return name


def stage_name_col(c: Column) -> Column:
    """Column form of ``stage_name``.

    No keyword of the list is a suffix of another, so once one keyword has
    split the name no later keyword can match: the first keyword that applies
    is the only one, and one flat CASE gives the same result as the loop.
    """
    c = F.regexp_replace(c, _UPPER_RUN, "$1_$2")
    c = F.regexp_replace(c, _LOWER_UPPER, "$1_$2")
    c = F.regexp_replace(F.lower(c), _NON_ALNUM, "_")
    c = F.regexp_replace(c, r"^_+|_+$", "")
    out = None
    for kw in STAGE_KEYWORDS:
        hit = c.endswith(kw) & (F.length(c) > len(kw)) & ~c.endswith("_" + kw)
        split = F.concat(c.substr(F.lit(1), F.length(c) - len(kw)), F.lit("_" + kw))
        out = F.when(hit, split) if out is None else out.when(hit, split)
    return out.otherwise(c)
