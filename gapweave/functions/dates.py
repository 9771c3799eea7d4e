from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shape(pattern: str) -> str | None:
    """Regular expression of the texts a purely numeric date format can match."""
    pieces = re.findall(r"([A-Za-z])(\1*)|('[^']*')|([^A-Za-z'])", pattern)
    shape = ""
    for letter, more, quoted, other in pieces:
        if letter:
            if letter not in "yMdHhms" or (letter == "M" and len(more) > 1):
                return None
            shape += r"\d+" if not more else r"\d{%d}" % (len(more) + 1)
        else:
            shape += re.escape(quoted.strip("'") or other)
    return f"^{shape}$"


def parse_date(c: Column, formats: Sequence[str]) -> Column:
    """Timestamp by the first format that fits, null where none does.

    A format is tried only on texts of its shape, as a failed attempt costs an exception in the JVM.
    """
    attempts = []
    for pattern in formats:
        parsed = F.try_to_timestamp(c, F.lit(pattern))
        shape = _shape(pattern)
        attempts.append(F.when(c.rlike(shape), parsed) if shape else parsed)
    return F.coalesce(*attempts).cast("timestamp_ntz")
