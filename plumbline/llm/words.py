"""Words: the longest runs of Unicode letters and digits, in lower case. An underscore is neither."""

from __future__ import annotations

import re

_WORD = re.compile(r"[^\W_]+")


def words(text: str | None) -> list[str]:
    """The words of a whole text, in order; none for NULL."""
    return _WORD.findall(text.lower()) if text else []
