"""Unsupervised detectors: ``Detector.fit(df) -> Model``, ``Model.score(df) -> df + score, pred``."""

from logwarden.detectors.factory import make_detector

__all__ = ["make_detector"]
