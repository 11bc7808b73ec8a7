"""The settings of a run, read from JSON and checked before anything starts."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, fields, replace

from ..operators.decide import KINDS


@dataclass(frozen=True)
class Config:
    # Fixed names and defaults: the keys of a configuration file.
    data_root: str = "dataset"
    output_dir: str = "output"
    cache_dir: str = "cache"
    model_dir: str = "models"
    seed: int = 42
    validation_fraction: float = 0.2
    minhash_permutations: int = 48
    minhash_bands: int = 12
    ngram_size: int = 3
    max_candidates_per_entity: int = 60
    max_posting_size: int = 500
    rf_estimators: int = 240
    threshold_min: float = 0.5
    threshold_max: float = 0.99
    threshold_steps: int = 50
    cardinality: str = "infer"
    random_forest_max_depth: int | None = None
    dense_model_name: str | None = None
    dense_top_k: int = 20
    source2_top_k: int = 8
    source3_top_k: int = 8
    max_train_records: int | None = None

    def problems(self) -> list[str]:
        checks = {
            "validation_fraction lies between 0 and 1": 0 < self.validation_fraction < 1,
            "max_candidates_per_entity is at least 1": self.max_candidates_per_entity >= 1,
            "minhash_bands divides minhash_permutations": self.minhash_bands > 0 and self.minhash_permutations % self.minhash_bands == 0,
            f"cardinality is infer or one of {', '.join(KINDS)}": self.cardinality in ("infer", *KINDS),
        }
        return [rule for rule, holds in checks.items() if not holds]

    def within(self, base: str) -> Config:
        """With relative folders taken from ``base``; folders with a scheme stay as they are."""
        placed = {n: v if "://" in v else os.path.normpath(os.path.join(base, v)) for n, v in asdict(self).items() if n in ("data_root", "output_dir", "cache_dir", "model_dir")}
        return replace(self, **placed)


def load(path: str | None = None, **given) -> Config:
    """Defaults, then the file's keys, then those of ``given`` that are not None. Unknown keys raise."""
    found = {}
    if path is not None:
        with open(path, encoding="utf-8") as f:
            found = json.load(f)
    odd = sorted(set(found) - {f.name for f in fields(Config)})
    if odd:
        raise ValueError(f"unknown settings: {', '.join(odd)}")
    config = Config(**(found | {k: v for k, v in given.items() if v is not None}))
    if broken := config.problems():
        raise ValueError(f"settings must be such that {'; '.join(broken)}")
    return config
