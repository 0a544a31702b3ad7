"""Alert sentences, rendered as one JVM-side concat each."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

# The alert sentences. "code" is the wording in the output files, "documented"
# the wording in the rule descriptions.
TEMPLATES = {
    "code": {
        "dormant": "First new bill in {months} months from vendor `{vendor}`",
        "accrual": "Line items from vendor `{vendor}` in this invoice cover future periods ({end})",
        "spend": "Monthly spend with `{vendor}` is ${spend} ({versus}%) higher than average.",
        "missing": (
            "`{vendor}` generally charges between on {day} day of each {unit} invoices are sent. "
            "On {date}, an invoice from `{vendor}` has not been received."
        ),
    },
    "documented": {
        "dormant": "First new bill in {months} months from vendor {vendor}",
        "accrual": (
            "Line items from vendor {vendor} in this invoice cover future periods (through {end})"
        ),
        "spend": "Monthly spend with {vendor} is ${spend} ({versus}%) higher than average",
        "missing": (
            "{vendor} generally charges between on {day} day of each {unit} invoices are sent. "
            "On {date}, an invoice from {vendor} has not been received"
        ),
    },
}


def render(template: str, **values: Column) -> Column:
    """Fill ``{name}`` placeholders with columns; NULL in any of them makes the text NULL."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(values[name])
    return F.concat(*parts)


def sentence(kind: str, rules: str, **values: Column) -> Column:
    return render(TEMPLATES[rules][kind], **values)
