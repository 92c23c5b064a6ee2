"""Configuration: YAML files with includes, settings per sample or per class of samples."""

from __future__ import annotations

import os
from collections.abc import Mapping
from typing import Any

#: Keys that stand for all, the experimental and the spike-in samples.
GROUPS = ("_all", "_exp", "_spk")


def merged(base: Any, over: Any) -> Any:
    """Deep merge; where both sides have a value, the right one counts."""
    if isinstance(base, Mapping) and isinstance(over, Mapping):
        return {k: merged(base[k], over[k]) if k in base and k in over else over.get(k, base.get(k)) for k in [*base, *[k for k in over if k not in base]]}
    return over


def load(path: str, include_dir: str | None = None, _open: tuple[str, ...] = ()) -> dict[str, Any]:
    """A YAML file over the files that it includes, in order; an include in a circle is an error."""
    import yaml

    path = os.path.abspath(path)
    if path in _open:
        raise ValueError(f"{path} includes itself")
    with open(path, encoding="utf-8") as file:
        own = yaml.safe_load(file) or {}
    names = own.pop("include", [])
    out: dict[str, Any] = {}
    for name in [names] if isinstance(names, str) else names:
        out = merged(out, load(os.path.join(include_dir or os.path.dirname(path), name), include_dir, (*_open, path)))
    return merged(out, own)


def expanded(node: Any, groups: Mapping[str, list[str]]) -> Any:
    """The keys _all, _exp and _spk replaced by one entry for each of their samples, at any depth."""
    if not isinstance(node, Mapping):
        return node
    out: dict[str, Any] = {}
    for key, value in node.items():
        if key in groups:
            out |= {sample: expanded(value, groups) for sample in groups[key]}
        else:
            out[key] = expanded(value, groups)
    return out


def with_samples(settings: Mapping[str, Any]) -> dict[str, Any]:
    """Settings with their groups expanded over experimental_samples and spikein_samples."""
    exp, spk = sorted(settings.get("experimental_samples") or []), sorted(settings.get("spikein_samples") or [])
    return expanded(settings, dict(zip(GROUPS, (exp + spk, exp, spk))))


def spikeins_first(design_lengths: Mapping[str, float | None], samples: list[str]) -> list[str]:
    """Samples in order of design length; those without one come last, by name."""
    return sorted(samples, key=lambda s: (design_lengths.get(s) if design_lengths.get(s) is not None else float("inf"), s))
