"""Text column functions: Unicode strip, templates, word splitting.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters Python's ``str.isspace`` accepts, as one regex
# class. Spark's ``trim`` removes only U+0020, so it cannot stand in for
# ``str.strip``. U+200B and U+FEFF are not whitespace and stay.
WS_CLASS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# The reference's templates.
QA_TEMPLATE = "Q: {question} A: {answer}"
PROMPT_TEMPLATE = "Q: {question} A:"

_FIELD = re.compile(r"\{(\w+)\}")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python ``str.strip()`` on a string column (leading and trailing Unicode whitespace)."""
    return F.regexp_replace(_col(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def is_blank(c) -> Column:
    """True when the string is empty after ``strip_ws``."""
    return F.length(strip_ws(c)) == 0


def split_words(c) -> Column:
    """Whitespace-run split with empty pieces dropped (Python ``str.split()``): outer
    whitespace leaves an empty piece, so one pass over the text does."""
    return F.filter(F.split(_col(c), f"{WS_CLASS}+"), lambda w: w != F.lit(""))


def normalise_ws(c) -> Column:
    """Whitespace runs become one space, outer whitespace removed."""
    return F.array_join(split_words(c), " ")


def format_template(template: str, **fields) -> Column:
    """Fill ``{name}`` slots of a template from columns, as one ``concat``.

    Parsed on the driver once; the row work is a plain ``concat``. A field that
    is NULL makes the result NULL, as a missing key would fail in Python.
    """
    parts: list[Column] = []
    pos = 0
    for m in _FIELD.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        name = m.group(1)
        if name not in fields:
            raise KeyError(f"template field {name!r} has no column")
        parts.append(_col(fields[name]))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if parts else F.lit("")


def format_qa(question="question", answer="answer", template: str = QA_TEMPLATE, strip: bool = True) -> Column:
    """Training record text (P3). The tokenizer path strips both fields, the
    training path formats them raw; ``strip`` selects which."""
    q, a = _col(question), _col(answer)
    if strip:
        q, a = strip_ws(q), strip_ws(a)
    return format_template(template, question=q, answer=a)


def format_prompt(question="question", template: str = PROMPT_TEMPLATE) -> Column:
    """Inference prompt ``Q: {question} A:``."""
    return format_template(template, question=_col(question))
