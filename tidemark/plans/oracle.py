"""Named relations for the oracle SQL, added to a statement only when it uses them.

The oracle is DuckDB SQL over the given tables. A statement names the relations
it needs (raw_trips, silver_trips, dim_driver, fact_trip, ...) and `statement`
puts their definitions, in dependency order, in front of it.
"""

from __future__ import annotations

import re

from tidemark.plans import trucking

RELATIONS: dict[str, str] = {}

for _name, _text in trucking.source_sql(trucking.DUCK).items():
    RELATIONS[f"raw_{_name}"] = _text.format(**trucking.DUCK.given)


def define(name: str, text: str) -> None:
    RELATIONS[name] = text


def words(text: str) -> list[str]:
    """The relations a text names."""
    return [w for w in dict.fromkeys(re.findall(r"[a-z_][a-z0-9_]*", text)) if w in RELATIONS]


def variant(name: str, suffix: str, changed: dict[str, str], fixed: str = "dim_") -> str:
    """A relation as it would be over other inputs: its name with the suffix, defined over the changed ones.

    changed maps relations to their other definition. Relations that start with fixed stay as they are, and so do those
    that depend on nothing changed.
    """
    def depends(relation: str) -> bool:
        return relation in changed or not relation.startswith(fixed) and any(depends(w) for w in words(RELATIONS[relation]))

    if not depends(name):
        return name
    if f"{name}{suffix}" not in RELATIONS:
        text = changed.get(name)
        if text is None:
            text = re.sub(r"[a-z_][a-z0-9_]*", lambda m: variant(m[0], suffix, changed, fixed) if m[0] in RELATIONS and not m[0].startswith(fixed) else m[0], RELATIONS[name])
        define(f"{name}{suffix}", text)
    return f"{name}{suffix}"


def _needed(text: str, found: list[str]) -> None:
    for word in re.findall(r"[a-z_][a-z0-9_]*", text):
        if word in RELATIONS and word not in found:
            _needed(RELATIONS[word], found)
            if word not in found:
                found.append(word)


def statement(body: str, casts: str) -> str:
    found: list[str] = []
    _needed(body, found)
    parts = [f"{name} AS ({RELATIONS[name]})" for name in found] + [f"result AS ({body})"]
    return "WITH " + ",\n".join(parts) + f"\nSELECT {casts} FROM result"
