"""Rule, policy and pipeline documents: JSON, or YAML where a YAML package is installed."""

from __future__ import annotations

import json
import os
from typing import Any

def read_document(path: str) -> dict[str, Any]:
    if not os.path.exists(path):
        raise FileNotFoundError(f"document not found: {path}")
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as exc:
        raise RuntimeError(f"{path}: reading YAML needs a YAML package; JSON works without") from exc
    return yaml.safe_load(text) or {}
