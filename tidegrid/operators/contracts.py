"""Contracts of entities, features and decisions: read from a folder, checked one by one and against each other.

A folder holds entities, features and decisions, a file for each contract named by its id: JSON, or YAML where a YAML reader is
installed. All problems are told at once.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path

try:
    import yaml
except ModuleNotFoundError:
    yaml = None

AGGREGATIONS = {"sum", "mean", "max", "min", "count", "last"}


@dataclass
class Contracts:
    entities: dict[str, dict] = field(default_factory=dict)
    features: dict[str, dict] = field(default_factory=dict)
    decisions: dict[str, dict] = field(default_factory=dict)

    def scope(self, resources: list[str] = (), models: list[str] = ()) -> dict[str, list[str]]:
        """What an erasure has to reach: personal entities and features, tagged resources, and models that can only be bounded."""
        personal = lambda kind: sorted(k for k, c in kind.items() if c.get("personal_data"))
        return {"entities": personal(self.entities), "features": personal(self.features), "resources": sorted(resources), "models": sorted(models)}


def _read(path: Path) -> dict:
    text = path.read_text(encoding="utf-8")
    made = yaml.safe_load(text) if path.suffix in (".yaml", ".yml") else json.loads(text)
    if not isinstance(made, dict):
        raise ValueError("a contract is a mapping")
    return made


def _entity(c: dict) -> list[str]:
    key, tracked = set(c.get("key", [])), set(c.get("tracked", []))
    out = [f"tracks its key {sorted(key & tracked)}"] if key & tracked else []
    if c.get("personal_data") and not (c.get("purpose") or "").strip():
        out.append("personal data without a purpose")
    dangling = sorted(r["via"] for r in c.get("references", []) if r["via"] not in key | tracked)
    return out + ([f"refers to others via {dangling}, which it doesn't hold"] if dangling else [])


def _feature(c: dict) -> list[str]:
    length, grain = c.get("length_seconds", 0), c.get("grain_seconds", 1)
    checks = {
        "unknown aggregation": c.get("aggregation") not in AGGREGATIONS, "length is no multiple of the grain": grain <= 0 or length % grain, "budget above the length": c.get("budget_seconds", 0) > length,
        "personal data without a purpose": c.get("personal_data") and not (c.get("purpose") or "").strip(), "fractional values": c.get("fractional"),
    }
    return [k for k, wrong in checks.items() if wrong]


def _decision(c: dict) -> list[str]:
    rule = c.get("fallback", {})
    excess = sorted(set(rule.get("permitted_actions", [])) - set(c.get("permitted_actions", [])))
    checks = {
        "automatic, with a significant effect on a person": c.get("effect") == "significant_on_person" and c.get("actuation") == "automatic", f"its fallback may also do {excess}": excess,
        "reads features and acts by itself without naming a model": c.get("features") and c.get("actuation") == "automatic" and not c.get("model"), "its fallback uses a model": rule.get("uses_model"), "its fallback reads features": rule.get("uses_features"),
    }
    return [k for k, wrong in checks.items() if wrong]


def load(folder: str) -> Contracts:
    """The contracts under folder; an error that lists every problem if there is one."""
    root, found, problems = Path(folder), Contracts(), []
    if not (root / "entities").is_dir():
        raise ValueError(f"no entities under {folder}")
    for kind, own in (("entities", _entity), ("features", _feature), ("decisions", _decision)):
        into = getattr(found, kind)
        for path in sorted(p for p in (root / kind).glob("*") if p.suffix in ((".json", ".yaml", ".yml") if yaml else (".json",))):
            try:
                c = _read(path)
            except ValueError as e:
                problems.append(f"{path.name}: {e}")
                continue
            except Exception as e:  # a YAML reader has errors of its own kind
                problems.append(f"{path.name}: not readable: {type(e).__name__}")
                continue
            name = c.get("id")
            problems += [f"{path.name}: declares id {name!r}"] if name != path.stem else []
            problems += [f"{path.name}: id {name!r} is taken"] if name in into else []
            problems += [f"{path.name}: {p}" for p in own(c)]
            into[name] = c
    for name, c in found.entities.items():
        for r in c.get("references", []):
            other = found.entities.get(r["entity"])
            if other is None:
                problems.append(f"{name}: refers to {r['entity']}, which isn't there")
            elif other.get("personal_data") and not c.get("personal_data"):
                problems.append(f"{name}: holds no personal data but refers to {r['entity']}, which does")
    for name, c in found.features.items():
        entity = found.entities.get(c.get("entity"))
        if entity is None:
            problems.append(f"{name}: a feature of {c.get('entity')}, which isn't there")
        elif entity.get("personal_data") and not c.get("personal_data"):
            problems.append(f"{name}: a feature of {c['entity']} is personal data")
    for name, c in found.decisions.items():
        problems += [f"{name}: reads {f}, which isn't there" for f in c.get("features", []) if f not in found.features]
    if problems:
        raise ValueError("contracts don't load:\n  " + "\n  ".join(sorted(problems)))
    return found
