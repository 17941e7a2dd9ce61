"""Column-name conventions."""

from __future__ import annotations

import re

_SEPARATORS = re.compile(r"[\s\-._]+")
# Word starts inside a camel-case name: after a lower-case letter or digit, and at the last
# capital of an acronym that runs into a word.
_WORD_START = re.compile(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])")


def to_snake_case(name: str) -> str:
    """``HTTPStatusCode`` -> ``http_status_code``, ``customer2ID`` -> ``customer2_id``."""
    parts = [p for p in _SEPARATORS.split(name) if p]
    return "_".join(w for p in parts for w in _WORD_START.split(p)).lower()
