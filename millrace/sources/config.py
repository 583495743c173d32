"""Source descriptions: a plain mapping, such as a parsed YAML file."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

_OPTION = re.compile(r"(\w+)\s*=\s*'([^']*)'")


@dataclass(frozen=True)
class Source:
    """One source: what it is called, where it lies and how to read it."""

    data_object: str
    path: str | None = None
    source_type: str = "local"
    format: str = "csv"
    options: Mapping[str, str] = field(default_factory=dict)


def parse_options(options) -> dict[str, str]:
    """Reader options from a mapping, or from text such as ``header='True', delimiter=','``.

    Text that is not a list of such pairs is an error.
    """
    if not options:
        return {}
    if isinstance(options, Mapping):
        return {str(k): str(v) for k, v in options.items()}
    rest = _OPTION.sub("", options)
    if rest.strip(" ,\t\n"):
        raise ValueError(f"these options cannot be read: {rest.strip()}")
    return dict(_OPTION.findall(options))


def parse_sources(config: Mapping) -> list[Source]:
    """The sources of a config mapping, in the order given."""
    return [
        Source(
            data_object=entry["data_object"],
            path=entry.get("path"),
            source_type=str(entry.get("source_type", "local")).lower(),
            format=str(entry.get("format", "csv")).lower(),
            options=parse_options(entry.get("options")),
        )
        for entry in config.get("sources", [])
    ]
