"""Score one chunk with the champion and cut a shortlist."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from chunkgate.operators import models
from chunkgate.operators.score import predicted_name, shortlist
from chunkgate.operators.validate import drop_null_rows, parsed_rows, require_rows, validated
from chunkgate.plans.settings import Settings
from chunkgate.plans.train import load_champion
from chunkgate.sources.chunks import read_chunk, write_shortlist
from chunkgate.sources.ledger import Ledger


def scored(valid: DataFrame, champion: PipelineModel | None, settings: Settings) -> DataFrame:
    """All valid rows with ``predicted_<target>``; scoring without a champion is an error."""
    if champion is None:
        raise ValueError("there is no champion to score with; train one first")
    featured = settings.with_features(valid)
    added = [c for c in featured.columns if c not in valid.columns]
    return models.predict(champion, featured, predicted_name(settings.target)).drop(*added)


def score_chunk(spark, raw_path: str, settings: Settings, ledger: Ledger, out: str | None = None) -> DataFrame:
    """The ranked shortlist of a chunk, also written as CSV when ``out`` is given.

    As in training, a scored row needs a key and a numeric target.
    """
    champion = load_champion(ledger, settings.model_name, settings)
    raw = read_chunk(spark, raw_path, settings.numeric_columns(), settings.multiline, settings.file_format)
    valid = validated(raw, settings.key, settings.target, ["ord"], settings.rule)
    # Some row is valid if one parses; asking ``valid`` would sort the whole chunk once more.
    if parsed_rows(drop_null_rows(raw, settings.key, settings.target), settings.key, settings.rule).isEmpty():
        require_rows(valid, raw.count())
    ranked = shortlist(
        scored(valid, champion, settings).drop("ord"),
        predicted_name(settings.target), settings.key, settings.shortlist_size, settings.rank_ascending,
    )
    if out is not None:
        write_shortlist(ranked, out)
    return ranked
