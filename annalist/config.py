"""Layered configuration: arguments over environment variables over a user's file over defaults."""

import copy
import json
import os
import re
from dataclasses import dataclass, field
from pathlib import Path

PREFIX = "ANNALIST_"

DEFAULTS: dict = {
    "paths": {"root": "data", "raw": {"base": "root", "path": "raw"}, "clean": {"base": "root", "path": "clean"}, "merged": {"base": "root", "path": "merged"}, "features": {"base": "root", "path": "features"}},
    "dataset": {"name": "longitudinal.parquet", "year_range": None},
    "clean": {"drop_duplicates": True, "null_threshold": None},
    "profiles": {"sample": {"dataset": {"name": "sample.parquet"}}, "real": {"dataset": {"name": "longitudinal.parquet"}}},
}


def merged(base: dict, over: dict) -> dict:
    """base with the values of over, dictionaries being merged in depth."""
    out = copy.deepcopy(base)
    for k, v in over.items():
        out[k] = merged(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else copy.deepcopy(v)
    return out


def parse(path: str | Path) -> dict:
    """A mapping from a JSON file, or a YAML one where a reader is installed."""
    text = Path(path).read_text(encoding="utf-8")
    if str(path).endswith((".yaml", ".yml")):
        import yaml

        found = yaml.safe_load(text) or {}
    else:
        found = json.loads(text)
    if not isinstance(found, dict):
        raise ValueError(f"{path} holds no mapping")
    return found


def read_value(text: str, like):
    """An environment variable's text as what its default is: a truth value, a number, a text; where the default is none, a range of years, a list or a number if it reads as one."""
    if isinstance(like, bool):
        if text.strip().lower() not in ("true", "false", "yes", "no", "1", "0"):
            raise ValueError(f"not true or false: {text!r}")
        return text.strip().lower() in ("true", "yes", "1")
    if isinstance(like, (int, float)):
        return type(like)(text)
    if isinstance(like, str):
        return text
    if years := re.fullmatch(r"\s*(\d{4})\s*[-,]\s*(\d{4})\s*", text):
        return [int(y) for y in years.groups()]
    try:
        return json.loads(text)
    except ValueError:
        return text


def from_environment(environ: dict[str, str], defaults: dict | None = None) -> dict:
    """ANNALIST_PATHS__ROOT=x as {"paths": {"root": "x"}}, values in the types of their defaults."""
    out: dict = {}
    for key, value in environ.items():
        if key.startswith(PREFIX):
            *parents, last = key.removeprefix(PREFIX).lower().split("__")
            at, like = out, DEFAULTS if defaults is None else defaults
            for p in parents:
                at = at.setdefault(p, {})
                like = like.get(p, {}) if isinstance(like, dict) else {}
            at[last] = read_value(value, like.get(last) if isinstance(like, dict) else None)
    return out


@dataclass
class Config:
    values: dict = field(default_factory=lambda: copy.deepcopy(DEFAULTS))
    #: The user's file that the values were read from, if any.
    source: str | None = None

    @classmethod
    def load(cls, path: str | Path | None = None, environ: dict[str, str] | None = None, **arguments) -> "Config":
        values = merged(DEFAULTS, parse(path) if path else {})
        values = merged(values, from_environment(dict(os.environ) if environ is None else environ, values))
        return cls(merged(values, arguments), str(path) if path else None).checked()

    def checked(self) -> "Config":
        if not str(self.values["dataset"]["name"]).endswith(".parquet"):
            raise ValueError("a dataset is a .parquet")
        return self

    def path(self, name: str, _seen: tuple[str, ...] = ()) -> str:
        """A named path; {base, path} is a path under another named one."""
        if name in _seen:
            raise ValueError(f"paths that need each other: {' -> '.join([*_seen, name])}")
        if name not in self.values["paths"]:
            raise KeyError(name)
        told = self.values["paths"][name]
        return f"{self.path(told['base'], (*_seen, name)).rstrip('/')}/{told['path']}" if isinstance(told, dict) else str(told)

    def dataset(self, folder: str = "merged") -> str:
        """The dataset's path; a year range names the file."""
        years = self.values["dataset"]["year_range"]
        name = f"{years[0]}-{years[1]}.parquet" if years else self.values["dataset"]["name"]
        return f"{self.path(folder)}/{name}"

    def profile(self, name: str) -> dict:
        """The settings of a named profile; changing them changes nothing here."""
        if name not in self.values["profiles"]:
            raise KeyError(f"no such profile: {name}")
        return copy.deepcopy(self.values["profiles"][name])

    def with_profile(self, name: str) -> "Config":
        """With a profile's settings over the others."""
        return self.updated(**self.profile(name))

    def updated(self, **changes) -> "Config":
        return Config(merged(self.values, changes), self.source).checked()

    def save(self, path: str | Path) -> "Config":
        Path(path).write_text(json.dumps(self.values, indent=2), encoding="utf-8")
        return Config(self.values, str(path))

    def reset(self, environ: dict[str, str] | None = None) -> "Config":
        """The defaults; the user's file that was read or saved goes. The environment still counts: it is not the user's settings."""
        if self.source:
            Path(self.source).unlink(missing_ok=True)
        return Config.load(None, environ)
