"""Recommenders behind one small interface, and the factory.

Every model turns a :class:`~flyway.plans.pipeline.FoldedData` into a long
prediction table ``(fold, observer_id, species, score, rank)`` for all folds at
once -- folds are a column, not a driver loop.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame


@dataclass
class Recommender:
    model_type: str
    params: dict[str, Any] = field(default_factory=dict)

    def recommend(self, data, k: int = 10) -> DataFrame:  # pragma: no cover - abstract
        raise NotImplementedError


class Popularity(Recommender):
    def recommend(self, data, k: int = 10) -> DataFrame:
        from .popularity import popularity_topk
        return popularity_topk(data.fold_trans, data.catalogue, k=k,
                               frozen_fold=self.params.get("frozen_fold", 1))


class Cooccurrence(Recommender):
    def recommend(self, data, k: int = 10) -> DataFrame:
        from ..operators.species import fold_species_features
        from .cooccurrence import cooccurrence_topk
        feats = None
        if self.params.get("boost", True):
            feats = fold_species_features(data.fold_trans, data.transitions,
                                          scope=self.params.get("scope", "train"))
        return cooccurrence_topk(data.fold_trans, data.transitions, data.folds, data.catalogue,
                                 data.n_species, k=k, alpha=self.params.get("alpha", 0.1),
                                 n_folds=data.n_folds, features=feats,
                                 min_cooccurrence=self.params.get("min_cooccurrence"))


class Neighbors(Recommender):
    def recommend(self, data, k: int = 10) -> DataFrame:
        from ..operators.species import fold_species_features
        from .neighbors import neighbor_topk
        feats = None
        if self.params.get("boost", False):
            feats = fold_species_features(data.fold_trans, data.transitions,
                                          scope=self.params.get("scope", "train"))
        return neighbor_topk(data.fold_trans, k=k,
                             metric=self.params.get("similarity_metric", "cosine"),
                             n_neighbors=self.params.get("n_similar_users", 50),
                             min_common=self.params.get("min_common_species", 1),
                             features=feats)


class Latent(Recommender):
    def recommend(self, data, k: int = 10) -> DataFrame:
        from .latent import latent_topk
        return latent_topk(data.fold_trans, k=k, **self.params)


class Learned(Recommender):
    def recommend(self, data, k: int = 10) -> DataFrame:
        from .learned import learned_topk
        return learned_topk(data, k=k, **self.params)


_TYPES = {"baseline": Popularity, "collaborative": Cooccurrence,
          "user_collaborative": Neighbors, "latent": Latent, "neural": Learned}


def create_model(model_type: str, **kwargs) -> Recommender:
    """Factory: baseline / collaborative / user_collaborative / latent / neural."""
    if model_type not in _TYPES:
        raise ValueError(f"Unknown model type: {model_type}")
    return _TYPES[model_type](model_type, dict(kwargs))
