"""Configuration: defaults from the fixed values, overlays from YAML or JSON files, validation and bundle hashes."""

from __future__ import annotations

import copy
import datetime as dt
import hashlib
import json
from dataclasses import dataclass
from pathlib import Path
from typing import Any

from siftwell.functions import fixed_values as V


class ConfigError(ValueError):
    """A configuration that can't be used."""


def sha256_json(value: Any) -> str:
    """Hash of the canonical JSON text: sorted keys, default separators, ASCII only."""
    return hashlib.sha256(json.dumps(value, sort_keys=True, default=str).encode()).hexdigest()


def defaults() -> dict[str, Any]:
    """The default configuration as plain data, by bundle."""
    return {
        "runtime": {"processing_mode": "memory", "chunk_size": 5000, "reference_date": V.REFERENCE_DATE, "progress_every_records": 10000},
        "rubric": {
            "lexicon": {n: {"terms": list(t), "field_weights": dict(w), "hit_divisors": dict(d), "evidence": e} for n, (t, w, d, e) in V.BASELINE_LEXICON.items()},
            "experience_bands": [{"min_years": a, "max_years": b, "score": s} for a, b, s in V.EXPERIENCE_BANDS],
            "location": {k: list(v) if isinstance(v, tuple) else v for k, v in V.LOCATION.items()},
            "availability": dict(V.BASELINE_AVAILABILITY),
        },
        "baseline": {"weights": dict(V.BASELINE_WEIGHTS), "penalty": dict(V.BASELINE_PENALTY), "low_relevance": dict(V.BASELINE_LOW)},
        "evidence": {
            n: {"polarity": p, "weight": w, "cap": cap, "recent_years": ry, "older_multiplier": om, "current_multiplier": 1.0, "require_corroboration": rc, "match_divisor": V.MATCH_DIVISOR,
                "source_weights": dict(zip(V.SOURCE_TYPES, sw, strict=True)), "terms": list(t)}
            for n, (p, w, cap, ry, om, rc, sw, t) in V.EVIDENCE.items()
        },
        "scoring": {"weights": dict(V.FEATURE_WEIGHTS), "semantic_cap": V.SEMANTIC_CAP},
        "credibility": {
            "severe_min": V.SEVERE_MIN,
            "rules": {n: {"enabled": True, "severity": s, "score_contribution": c, "explanation_label": e, "candidate_facing_reasoning": False} for n, (s, c, e) in V.RULES.items()},
            "max_overlap_months": V.MAX_OVERLAP_MONTHS, "corroboration_threshold": V.UNSUPPORTED_THRESHOLD, "minimum_skill_count": 1, "minimum_title_hits": 1,
            "risky_skill_terms": list(V.RISKY_SKILL_TERMS), "title_terms": list(V.TITLE_TERMS), "support_terms": list(V.SUPPORT_TERMS),
        },
        "behavioral": {
            "weights": dict(V.AVAILABILITY_WEIGHTS), "base": V.AVAILABILITY_BASE, "min": V.AVAILABILITY_MIN, "max": V.AVAILABILITY_MAX,
            "location": {k: list(v) if isinstance(v, tuple) else v for k, v in V.LOCATION.items()}, "recency": dict(V.RECENCY),
        },
        "semantic": {"enabled": False, "artifact_path": "artifacts/semantic/semantic_scores.parquet", "manifest_path": "artifacts/semantic/semantic_manifest.json", "model_identifier": "offline-only"},
    }


#: Which bundles a stage depends on; every stage depends on the rubric.
STAGE_BUNDLES = {
    "audit": ("runtime",), "normalize": ("runtime",), "baseline": ("rubric", "baseline"), "evidence": ("rubric", "evidence"), "credibility": ("rubric", "credibility"),
    "behavioral": ("rubric", "behavioral"), "scores": ("rubric", "scoring", "semantic"), "reasoning": ("rubric",), "submission": ("rubric",),
}


@dataclass(frozen=True)
class Config:
    data: dict[str, Any]

    def __getitem__(self, bundle: str) -> dict[str, Any]:
        return self.data[bundle]

    @property
    def reference_date(self) -> dt.date:
        return dt.date.fromisoformat(self.data["runtime"]["reference_date"])

    def hash_of(self, *bundles: str) -> str:
        return sha256_json({b: self.data[b] for b in bundles})

    def stage_hash(self, stage: str) -> str:
        return self.hash_of(*STAGE_BUNDLES[stage])

    def with_runtime(self, **changes: Any) -> Config:
        """A validated copy with other values of the runtime bundle."""
        data = copy.deepcopy(self.data)
        data["runtime"] |= changes
        validate(data)
        return Config(data)

    def with_(self, **changes: dict[str, Any]) -> Config:
        """A validated copy with some values of its bundles replaced."""
        return load(changes)


def _merge(base: dict, over: dict, path: str) -> None:
    for k, v in over.items():
        if k not in base and path not in ("evidence", "credibility.rules", "rubric.lexicon"):
            raise ConfigError(f"unknown key: {path}.{k}" if path else f"unknown bundle: {k}")
        if isinstance(v, dict) and isinstance(base.get(k), dict):
            _merge(base[k], v, f"{path}.{k}" if path else k)
        else:
            base[k] = v


def _number(value: Any, name: str, low: float = 0.0, high: float = float("inf")) -> float:
    if isinstance(value, bool) or not isinstance(value, (int, float)) or not low <= value <= high:
        raise ConfigError(f"{name} must be a number from {low} to {high}: {value!r}")
    return float(value)


def _sums_to_one(values: dict[str, Any], name: str) -> None:
    total = sum(_number(v, f"{name}.{k}", 0, 1) for k, v in values.items())
    if abs(total - 1) > 1e-6:
        raise ConfigError(f"{name} must sum to 1.0, not {total}")


def _strings(values: Any, name: str, least: int = 1) -> None:
    if not isinstance(values, (list, tuple)) or len(values) < least or not all(isinstance(v, str) and v.strip() for v in values):
        raise ConfigError(f"{name} must be a list of non-empty strings")


def validate(data: dict[str, Any]) -> None:
    run = data["runtime"]
    if run["processing_mode"] not in ("memory", "chunked"):
        raise ConfigError(f"runtime.processing_mode must be memory or chunked: {run['processing_mode']!r}")
    if isinstance(run["chunk_size"], bool) or not isinstance(run["chunk_size"], int) or run["chunk_size"] < 1:
        raise ConfigError("runtime.chunk_size must be a positive integer")
    try:
        dt.date.fromisoformat(str(run["reference_date"]))
    except ValueError as e:
        raise ConfigError("runtime.reference_date must be an ISO date") from e
    run["reference_date"] = str(run["reference_date"])
    _sums_to_one(data["baseline"]["weights"], "baseline.weights")
    for k, v in data["baseline"]["penalty"].items():
        _number(v, f"baseline.penalty.{k}", 0, 1)
    for n, c in data["rubric"]["lexicon"].items():
        _strings(c["terms"], f"rubric.lexicon.{n}.terms")
        _sums_to_one(c["field_weights"], f"rubric.lexicon.{n}.field_weights")
        if set(c["hit_divisors"]) != set(c["field_weights"]):
            raise ConfigError(f"rubric.lexicon.{n}: each field needs a divisor")
        for k, v in c["hit_divisors"].items():
            _number(v, f"rubric.lexicon.{n}.hit_divisors.{k}", 1)
    for b in data["rubric"]["experience_bands"]:
        if _number(b["min_years"], "min_years") > _number(b["max_years"], "max_years"):
            raise ConfigError("an experience band ends before it starts")
        _number(b["score"], "experience band score", 0, 1)
    if not data["evidence"]:
        raise ConfigError("evidence needs a category")
    for n, c in data["evidence"].items():
        missing = {"polarity", "weight", "cap", "source_weights", "terms"} - set(c)
        if missing:
            raise ConfigError(f"evidence.{n} lacks {sorted(missing)}")
        if c["polarity"] not in ("positive", "negative"):
            raise ConfigError(f"evidence.{n}.polarity must be positive or negative")
        _strings(c["terms"], f"evidence.{n}.terms")
        _number(c["weight"], f"evidence.{n}.weight")
        _number(c["cap"], f"evidence.{n}.cap")
        unknown = set(c["source_weights"]) - set(V.SOURCE_TYPES)
        if unknown:
            raise ConfigError(f"evidence.{n}: unknown sources {sorted(unknown)}")
        for k, v in c["source_weights"].items():
            _number(v, f"evidence.{n}.source_weights.{k}", 0, 1)
        for k, v in {"recent_years": 5, "older_multiplier": 0.85, "current_multiplier": 1.0, "require_corroboration": False, "match_divisor": V.MATCH_DIVISOR}.items():
            c.setdefault(k, v)
    _sums_to_one(data["scoring"]["weights"], "scoring.weights")
    _number(data["scoring"]["semantic_cap"], "scoring.semantic_cap", 0, 1)
    for n, r in data["credibility"]["rules"].items():
        for k in ("enabled", "severity", "score_contribution", "explanation_label"):
            if k not in r:
                raise ConfigError(f"credibility.rules.{n} lacks {k}")
        if r["severity"] not in ("minor", "moderate", "severe"):
            raise ConfigError(f"credibility.rules.{n}: unknown severity {r['severity']!r}")
        if not isinstance(r["enabled"], bool):
            raise ConfigError(f"credibility.rules.{n}.enabled must be true or false")
        _number(r["score_contribution"], f"credibility.rules.{n}.score_contribution", 0, 1)
    for k, v in data["behavioral"]["weights"].items():
        _number(v, f"behavioral.weights.{k}", 0, 1)
    if not 0 < data["behavioral"]["min"] <= data["behavioral"]["max"]:
        raise ConfigError("behavioral.min must be positive and not above behavioral.max")
    if not isinstance(data["semantic"]["enabled"], bool):
        raise ConfigError("semantic.enabled must be true or false")


def load(overlay: dict[str, Any] | None = None) -> Config:
    data = defaults()
    _merge(data, copy.deepcopy(overlay or {}), "")
    validate(data)
    return Config(data)


def _yaml():
    try:
        import yaml
    except ImportError as e:
        raise ConfigError("YAML files need PyYAML; JSON files don't") from e
    return yaml


def read_mapping(path: Path) -> dict[str, Any]:
    """A mapping from a YAML or JSON file."""
    text = path.read_text(encoding="utf-8")
    try:
        value = _yaml().safe_load(text) if path.suffix in (".yaml", ".yml") else json.loads(text)
    except ValueError as e:
        raise ConfigError(f"{path}: {e}") from e
    except Exception as e:
        if isinstance(e, ConfigError) or type(e).__module__.split(".")[0] != "yaml":
            raise
        raise ConfigError(f"{path}: {e}") from e
    if not isinstance(value, dict):
        raise ConfigError(f"{path} must hold a mapping")
    return value


def write_folder(config: Config, folder: str | Path, fmt: str = "yaml") -> list[Path]:
    """Every bundle as a file of its own, whole: what ``load_folder`` reads."""
    out = []
    for name, data in config.data.items():
        text = _yaml().safe_dump(data, sort_keys=False, allow_unicode=True) if fmt == "yaml" else json.dumps(data, indent=2, ensure_ascii=False) + "\n"
        path = Path(folder) / f"{name}.{fmt}"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        out.append(path)
    return out


def load_folder(folder: str | Path) -> Config:
    """A configuration from a folder with one file for each bundle (``name.yaml``, ``name.yml`` or ``name.json``); nothing is filled in."""
    known, data = defaults(), {}
    for path in sorted(Path(folder).iterdir()):
        if path.suffix not in (".yaml", ".yml", ".json"):
            continue
        if path.stem not in known:
            raise ConfigError(f"unknown bundle: {path.stem}")
        if path.stem in data:
            raise ConfigError(f"two files for {path.stem}")
        data[path.stem] = read_mapping(path)
    if missing := [b for b in known if b not in data]:
        raise ConfigError(f"{folder} lacks the bundles {missing}")
    for bundle in known:
        if lacking := [k for k in known[bundle] if k not in data[bundle]] if bundle != "evidence" else []:
            raise ConfigError(f"{bundle} lacks {lacking}")
    data = {b: data[b] for b in known}
    validate(data)
    return Config(data)


def load_files(*paths: str | Path) -> Config:
    """Defaults with overlay files on top, in order; YAML where that module is there, JSON always."""
    overlay: dict[str, Any] = {}
    for path in map(Path, paths):
        for k, v in read_mapping(path).items():
            overlay[k] = {**overlay.get(k, {}), **v} if isinstance(v, dict) else v
    return load(overlay)
