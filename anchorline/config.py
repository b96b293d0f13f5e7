"""Settings of a run: a YAML or JSON file, with the data folder from the environment where it is set."""

from __future__ import annotations

import json
import os
from dataclasses import fields, replace

from anchorline.engine import Config

#: Overrides ``data_root`` of the file.
ROOT_VARIABLE = "ANCHORLINE_DATA_ROOT"


def parse(text: str, kind: str) -> dict:
    if kind in ("yaml", "yml"):
        import yaml

        return yaml.safe_load(text) or {}
    return json.loads(text) if text.strip() else {}


def load(path: str) -> tuple[Config, dict[str, dict]]:
    """The run's settings and those of each source. A relative data folder lies beside the file."""
    with open(path, encoding="utf-8") as f:
        data = parse(f.read(), path.rsplit(".", 1)[-1].lower())
    root = os.environ.get(ROOT_VARIABLE) or data.get("data_root") or "data"
    if "://" not in root and not os.path.isabs(root):
        root = os.path.join(os.path.dirname(os.path.abspath(path)), root)
    given = {**(data.get("temporal") or {}), **(data.get("run") or {})}
    known = {f.name for f in fields(Config)} - {"root"}
    settings = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items() if k in known}
    return replace(Config(root), **settings), {k: dict(v or {}) for k, v in (data.get("sources") or {}).items()}
