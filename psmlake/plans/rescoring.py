"""Spectral features, cross-validated rescoring, q-values and their summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from psmlake.functions.decoy import with_inferred
from psmlake.operators import fdr, rescore, spectral

#: Columns that only feed the model.
SCORES = ("rescore_prob", "xpec_q", "xpec_pepq", "xpec_score")


def rescored(psms: DataFrame, tie: Sequence[str], spectra: DataFrame | None = None, n_folds: int = 5, n_members: int = 2, seed: int = 42, most_trees: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(input columns and four scores, feature importance, gains per sample).  `psms` has a unique psm_id that no later read changes."""
    rows = with_inferred(psms, "Protein")
    if spectra is not None:
        rows = spectral.with_spectral_features(rows, spectral.extract(rows, spectra).drop("spectral_feature_error"))
    scored, importance = rescore.cross_validated(rows, n_folds, n_members, seed, most_trees=most_trees)
    done = rescore.combined(scored, tie, check=True)
    names = list(dict.fromkeys([*psms.columns, "is_decoy", *SCORES]))
    done = done.select(*names)
    return done, importance, fdr.gains(done, "QValue", "xpec_q") if "QValue" in done.columns else fdr.gains(done.withColumn("QValue", done["xpec_q"]), "QValue", "xpec_q")
