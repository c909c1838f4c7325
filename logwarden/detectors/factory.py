"""Detector by method name, and models by what the store holds."""

from __future__ import annotations

import numpy as np

from logwarden.detectors.autoencoder import AutoencoderDetector, AutoencoderModel
from logwarden.detectors.base import Detector, Model
from logwarden.detectors.deviation import DeviationDetector, DeviationModel
from logwarden.detectors.ensemble import EnsembleDetector, EnsembleModel
from logwarden.detectors.forest import ForestDetector, ForestModel
from logwarden.detectors.linear import LinearDetector, LinearModel
from logwarden.detectors.sequence import SequenceDetector, SequenceModel

_DETECTORS = {
    "deviation": DeviationDetector,
    "isolation_forest": ForestDetector,
    "autoencoder": AutoencoderDetector,
    "linear": LinearDetector,
    "sequence": SequenceDetector,
    "lstm": SequenceDetector,
}
_MODELS = {m.method: m for m in (DeviationModel, ForestModel, AutoencoderModel, LinearModel,
                                 SequenceModel, EnsembleModel)}
METHODS = (*_DETECTORS, "ensemble")


def make_detector(method: str = "isolation_forest", **settings) -> Detector:
    """A detector with the given settings; an unknown name is an error.

    ``ensemble`` takes ``detectors=[...]`` or builds a forest and an autoencoder from the
    remaining settings.
    """
    if method in _DETECTORS:
        return _DETECTORS[method](**settings)
    if method != "ensemble":
        raise ValueError(f"Unknown method: {method}")
    own = {k: settings.pop(k) for k in ("voting_method", "normalise", "threshold_on") if k in settings}
    members = settings.pop("detectors", None)
    if members is None:
        members = [ForestDetector(**settings), AutoencoderDetector(**settings)]
    elif settings:
        own |= {"contamination": settings.pop("contamination", 0.1)}
        if settings:
            raise ValueError(f"settings belong to the members: {sorted(settings)}")
    return EnsembleDetector(members, **own)


def restore_model(params: dict, arrays: dict[str, np.ndarray]) -> Model:
    return _MODELS[params["method"]].restore(params, arrays)
