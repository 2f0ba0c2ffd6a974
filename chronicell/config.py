"""Settings: nested files as flat dotted keys, overrides from the command line, secrets from a file of their own."""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence
from pathlib import Path

from chronicell.sources.binlog import flatten_config


def with_prefix(settings: dict, prefix: str) -> dict:
    """The settings under a prefix, without it."""
    return {k.removeprefix(prefix): v for k, v in settings.items() if k.startswith(prefix)}


def read_file(path: str) -> dict:
    """A JSON file, or a YAML file where the YAML module is installed, as flat keys."""
    text = Path(path).read_text()
    if path.endswith(".json"):
        return flatten_config(json.loads(text))
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("settings in YAML need the module yaml; JSON does not") from e
    return flatten_config(yaml.safe_load(text) or {})


def _typed(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return text


def from_arguments(arguments: Sequence[str]) -> dict:
    """Settings of ``--config-file FILE --secret-file FILE --config key=value ...``; later ones win, in this order."""
    parser = argparse.ArgumentParser(prog="chronicell")
    parser.add_argument("--config-file")
    parser.add_argument("--secret-file")
    parser.add_argument("--config", action="append", default=[], metavar="KEY=VALUE")
    given = parser.parse_args(list(arguments))
    settings = read_file(given.config_file) if given.config_file else {}
    if given.secret_file:
        settings |= flatten_config(json.loads(Path(given.secret_file).read_text()))
    for pair in given.config:
        key, equals, value = pair.partition("=")
        if not equals:
            parser.error(f"no key=value: {pair}")
        settings[key] = _typed(value)
    return settings
