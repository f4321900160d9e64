"""Arguments shared by the train, score and watch plans."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chunkgate import defaults
from chunkgate.functions.keys import Rule
from chunkgate.operators import models
from chunkgate.operators.bootstrap import replicates_by
from chunkgate.operators.gate import check_settings
from chunkgate.operators.identity import params_hash


@dataclass(frozen=True)
class Settings:
    """What a plan does with a chunk; the chunk itself is an argument of the plan.

    ``rule`` gives a key's canonical form and ``features`` adds the model's input
    vector; without them keys are collapsed texts and features their fingerprints.
    """

    key: str
    target: str
    model_name: str
    kind: str = defaults.MODEL_KIND
    params: dict = field(default_factory=dict)
    test_fraction: float = defaults.TEST_FRACTION
    split_seed: int = defaults.SPLIT_SEED
    fp_radius: int = defaults.FP_RADIUS
    fp_bits: int = defaults.FP_BITS
    min_samples: int = defaults.MIN_SAMPLES
    margin: float = defaults.MARGIN
    n_boot: int = defaults.N_BOOT
    gate_seed: int = defaults.GATE_SEED
    bootstrap: str = "poisson"
    shortlist_size: int = defaults.SHORTLIST_SIZE
    rank_ascending: bool = defaults.RANK_ASCENDING
    retrain_threshold: float = 0.5
    numeric: tuple[str, ...] = ()
    multiline: bool = False
    file_format: str = "csv"
    code_version: str = "unknown"
    rule: Rule | None = None
    features: Callable[[DataFrame], DataFrame] | None = None

    def __post_init__(self) -> None:
        if not self.model_name.strip():
            raise ValueError("a model needs a name")
        models.check_kind(self.kind)
        if not 0 < self.test_fraction < 1:
            raise ValueError("test_fraction lies strictly between 0 and 1")
        if self.fp_radius < 0 or self.fp_bits < 1 or self.shortlist_size < 1:
            raise ValueError("fp_radius cannot be negative, nor fp_bits or shortlist_size below 1")
        replicates_by(self.bootstrap)
        check_settings(self.min_samples, self.margin, self.n_boot)

    def numeric_columns(self) -> list[str]:
        return sorted({self.target, *self.numeric})

    def with_features(self, df: DataFrame) -> DataFrame:
        if self.features is not None:
            return self.features(df)
        return models.fingerprint_features(df, self.key, self.fp_radius, self.fp_bits)

    def feature_signature(self) -> str:
        """What the feature vector is made of, as far as settings tell."""
        if self.features is not None:
            return getattr(self.features, "__qualname__", type(self.features).__qualname__)
        return f"fingerprint of {self.key}: {self.fp_bits} bits, radius {self.fp_radius}"

    def config(self) -> dict[str, str]:
        """The plain settings as texts, for the run record."""
        plain = {f.name for f in fields(self)} - {"rule", "features", "code_version"}
        return {k: json.dumps(v, sort_keys=True) for k, v in asdict(self).items() if k in plain}

    def config_hash(self, spark) -> str:
        pairs = [F.lit(x) for pair in self.config().items() for x in pair]
        return spark.range(1).select(params_hash(F.create_map(*pairs))).first()[0]
