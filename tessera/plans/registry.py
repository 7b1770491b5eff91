"""All registered queries and their DuckDB oracles."""

from __future__ import annotations

from . import q_boost, q_eval, q_extra, q_features, q_native, q_prep, q_profiles, q_sources, q_train

MODULES = [q_features, q_profiles, q_prep, q_boost, q_eval, q_train, q_extra, q_native, q_sources]


def merged(parts: list[dict]) -> dict:
    """The parts as one; a name that two of them hold is an error."""
    out: dict = {}
    for part in parts:
        if twice := sorted(set(out) & set(part)):
            raise ValueError(f"registered twice: {twice}")
        out.update(part)
    return out


def all_queries() -> dict:
    return merged([m.Q for m in MODULES])


def all_oracles() -> dict:
    return merged([m.O for m in MODULES])
