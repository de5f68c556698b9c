"""Configuration: a typed tree with its invariants (FLT-13, FLT-14). Unknown keys are ignored."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any, get_type_hints

from skein.functions.lexicons import CATEGORY_WEIGHTS


@dataclass
class Validation:
    enabled: bool = True
    sample_rate: float = 0.12
    pass_threshold: float = 0.85
    reject_threshold: float = 0.70


@dataclass
class Synthetic:
    enabled: bool = True
    num_samples: int = 5000
    batch_size: int = 25
    shortest: int = 100
    longest: int = 2000
    categories: dict = field(default_factory=lambda: dict(CATEGORY_WEIGHTS))
    validation: Validation = field(default_factory=Validation)


@dataclass
class Dataset:
    train_ratio: float = 0.90
    valid_ratio: float = 0.05
    test_ratio: float = 0.05
    seed: int = 42
    synthetic: Synthetic = field(default_factory=Synthetic)


@dataclass
class Model:
    name: str = ""
    base_model: str = ""
    enabled: bool = True


@dataclass
class Training:
    max_seq_length: int = 2048
    lora_rank: int = 16
    lora_alpha: int = 32


@dataclass
class Quantization:
    bits: int = 4
    group_size: int = 64


@dataclass
class Config:
    platform: str = "linux"
    models: list = field(default_factory=list)
    dataset: Dataset = field(default_factory=Dataset)
    training: Training = field(default_factory=Training)
    quantization: Quantization = field(default_factory=Quantization)


def build(kind: type, data: dict[str, Any] | None):
    """A dataclass from nested dictionaries."""
    hints, values = get_type_hints(kind), {}
    for f in fields(kind):
        if f.name in (data or {}):
            value = data[f.name]
            values[f.name] = build(hints[f.name], value) if is_dataclass(hints[f.name]) and isinstance(value, dict) else value
    return kind(**values)


def load(data: dict[str, Any]) -> Config:
    """The configuration of a parsed file, once its invariants hold."""
    cfg = build(Config, data)
    cfg.models = [m if isinstance(m, Model) else build(Model, m) for m in cfg.models]
    if problems := broken(cfg):
        raise ValueError("; ".join(problems))
    return cfg


def load_yaml(text: str) -> Config:
    """The configuration of a YAML text; needs the yaml package."""
    try:
        import yaml
    except ImportError as e:
        raise ImportError("reading YAML needs the yaml package; load() takes a dictionary") from e
    data = yaml.safe_load(text)
    if not isinstance(data, dict):
        raise ValueError("the configuration is not a mapping")
    return load(data)


def broken(cfg: Config) -> list[str]:
    """The invariants that do not hold."""
    ds, synth, val = cfg.dataset, cfg.dataset.synthetic, cfg.dataset.synthetic.validation
    rules = [
        (cfg.platform in ("linux", "mac"), "platform must be linux or mac"),
        (bool(cfg.models), "no model"),
        (any(m.enabled for m in cfg.models), "no enabled model"),
        (all(m.name and m.base_model for m in cfg.models), "a model lacks name or base_model"),
        (abs(ds.train_ratio + ds.valid_ratio + ds.test_ratio - 1) <= 1e-6, "split ratios must sum to 1"),
        (cfg.training.max_seq_length > 0, "max_seq_length must be positive"),
        (cfg.training.lora_rank > 0 and cfg.training.lora_alpha > 0, "lora rank and alpha must be positive"),
        (cfg.quantization.bits > 0 and cfg.quantization.group_size > 0, "bits and group_size must be positive"),
    ]
    if synth.enabled:
        rules += [
            (synth.num_samples > 0, "num_samples must be positive"),
            (synth.batch_size > 0, "batch_size must be positive"),
            (abs(sum(synth.categories.values()) - 1) <= 1e-6, "category proportions must sum to 1"),
        ]
        if val.enabled:
            rules += [
                (0 < val.sample_rate <= 1, "sample_rate must be in (0, 1]"),
                (0 <= val.reject_threshold <= val.pass_threshold <= 1, "thresholds must be ordered"),
            ]
    return [what for holds, what in rules if not holds]


def enabled_models(cfg: Config, name: str | None = None) -> list[Model]:
    found = [m for m in cfg.models if m.enabled and (name is None or m.name == name)]
    if not found:
        raise ValueError(f"no enabled model {name or ''}; there are {[m.name for m in cfg.models]}")
    return found


def overridden(cfg: Config, **samples: int) -> Config:
    """A copy with other synthetic settings."""
    return replace(cfg, dataset=replace(cfg.dataset, synthetic=replace(cfg.dataset.synthetic, **samples)))
