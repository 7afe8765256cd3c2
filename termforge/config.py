"""Run configuration: JSON to dataclasses, with every problem named at once."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from pathlib import Path


@dataclass(frozen=True)
class RuntimeConfig:
    max_retries: int = 3
    retry_delay_ms: int = 1000
    memory_threshold: float = 0.8


@dataclass(frozen=True)
class MetaConfig:
    output_directory: str = "output"
    data_directory: str = "data"
    llm_directory: str | None = None


@dataclass(frozen=True)
class GeneralConfig:
    http_timeout_ms: int = 30_000
    user_agent: str = ""


@dataclass(frozen=True)
class ForumConfig:
    name: str = ""
    forum_url: str = ""
    forum_type: str = ""
    enabled: bool = True
    include: tuple[str, ...] | None = None
    exclude: tuple[str, ...] | None = None


@dataclass(frozen=True)
class LabelerConfig:
    # The intended defaults.
    enabled: bool = True
    language: str = "ru"
    dictionary_paths: tuple[str, ...] = ()
    min_sentence_length: int = 15
    max_sentence_length_for_context: int = 200
    min_language_ratio: float = 0.3
    max_special_char_ratio: float = 0.2
    max_sentences: int = 0


@dataclass(frozen=True)
class SiteConfig:
    site_id: str = ""
    base_url: str = ""
    forums: tuple[ForumConfig, ...] = ()
    labeler: LabelerConfig = field(default_factory=LabelerConfig)


@dataclass(frozen=True)
class Configuration:
    meta: MetaConfig = field(default_factory=MetaConfig)
    general: GeneralConfig = field(default_factory=GeneralConfig)
    runtime: RuntimeConfig = field(default_factory=RuntimeConfig)
    site: SiteConfig = field(default_factory=SiteConfig)


class ConfigError(ValueError):
    pass


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(w.title() for w in rest)


def _bind(kind, node, where: str, problems: list[str]):
    if not isinstance(node, dict):
        problems.append(f"{where} must be an object")
        return kind()
    values = {}
    for f in fields(kind):
        key = _camel(f.name)
        if key not in node or node[key] is None:
            continue
        value, default = node[key], f.default
        want = (int, float) if isinstance(default, float) else type(default) if default is not None and isinstance(default, bool | int | str) else None
        if want and (not isinstance(value, want) or isinstance(value, bool) != isinstance(default, bool)):
            problems.append(f"{where}.{key} has the wrong type")
            continue
        values[f.name] = tuple(value) if isinstance(value, list) else value
    return kind(**values)


def parse(root: dict) -> Configuration:
    """A configuration from its JSON tree; ConfigError names all that is wrong."""
    problems: list[str] = []
    site_node = root.get("site")
    if not isinstance(site_node, dict):
        raise ConfigError("site is required")
    problems += [f"site.{k} is required" for k in ("siteId", "baseUrl", "forums", "labeler") if k not in site_node]
    forums = []
    for i, node in enumerate(site_node.get("forums") or []):
        forum = _bind(ForumConfig, node, f"site.forums[{i}]", problems)
        problems += [f"site.forums[{i}].{k} is required" for k in ("name", "forumUrl", "forumType") if k not in node]
        if forum.include is not None and forum.exclude is not None:
            problems.append(f"site.forums[{i}]: include and exclude exclude each other")
        forums.append(forum)
    labeler = _bind(LabelerConfig, site_node.get("labeler") or {}, "site.labeler", problems)
    for name in ("min_language_ratio", "max_special_char_ratio"):
        if not 0 <= getattr(labeler, name) <= 1:
            problems.append(f"site.labeler.{_camel(name)} must be between 0 and 1")
    for name in ("min_sentence_length", "max_sentence_length_for_context", "max_sentences"):
        if getattr(labeler, name) < 0:
            problems.append(f"site.labeler.{_camel(name)} must not be negative")
    runtime = _bind(RuntimeConfig, root.get("runtime") or {}, "runtime", problems)
    if not 0 < runtime.memory_threshold <= 1:
        problems.append("runtime.memoryThreshold must be over 0 and at most 1")
    meta, general = _bind(MetaConfig, root.get("meta") or {}, "meta", problems), _bind(GeneralConfig, root.get("general") or {}, "general", problems)
    if problems:
        raise ConfigError("; ".join(problems))
    return Configuration(meta, general, runtime, SiteConfig(site_node["siteId"], site_node["baseUrl"], tuple(forums), labeler))


def load(path: str, resources: str | None = None) -> Configuration:
    """From a file; a relative path is looked up among ``resources`` if it is not there."""
    if not path or not path.strip():
        raise ConfigError("a path is required")
    found = Path(path)
    if not found.exists() and resources and not found.is_absolute():
        found = Path(resources) / path
    return parse(json.loads(found.read_text(encoding="utf-8")))


def config_names(folder: str) -> list[str]:
    return sorted(n for n in os.listdir(folder) if n.endswith(".json"))


def enabled_forums(config: Configuration) -> list[ForumConfig]:
    return [f for f in config.site.forums if f is not None and f.enabled]
