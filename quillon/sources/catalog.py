"""Recogniser catalogue: TOML tables to specifications, and the registry of kinds."""

from __future__ import annotations

import tomllib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any, Protocol


@dataclass(frozen=True)
class ModelSpec:
    name: str
    kind: str
    ref: str
    options: dict[str, Any] = field(default_factory=dict, hash=False)


class Recogniser(Protocol):
    """What a kind's factory returns; it is made once in each task."""

    def transcribe(self, clips: list[dict]) -> list[dict]:
        """A dict with text, confidence, no_speech and nbest for each clip, in order."""
        ...


def load_specs(path: str) -> dict[str, ModelSpec]:
    """The tables [models.<name>] of a TOML file; none without such a table."""
    tables = tomllib.loads(Path(path).read_text()).get("models", {})
    return {n: ModelSpec(n, t["kind"], t["ref"], {k: v for k, v in t.items() if k not in ("kind", "ref")}) for n, t in tables.items()}


_KINDS: dict[str, Callable[[ModelSpec], Recogniser]] = {}


def register_kind(kind: str, factory: Callable[[ModelSpec], Recogniser]) -> None:
    _KINDS[kind] = factory


def factory_of(spec: ModelSpec) -> Callable[[ModelSpec], Recogniser]:
    if spec.kind not in _KINDS:
        raise ValueError(f"unknown kind of model: {spec.kind}")
    return _KINDS[spec.kind]


def choose(specs: dict[str, ModelSpec], names: list[str]) -> Iterator[ModelSpec]:
    missing = [n for n in names if n not in specs]
    if missing:
        raise ValueError(f"models without a table: {', '.join(missing)}")
    return (specs[n] for n in names)


def check_weights(voters: list[str], weights: list[float] | None) -> list[float]:
    """One weight a voter; 1 each where none are given."""
    if not voters:
        raise ValueError("no voters")
    if weights is not None and len(weights) != len(voters):
        raise ValueError(f"{len(weights)} weights for {len(voters)} voters")
    return [1.0] * len(voters) if weights is None else list(weights)
