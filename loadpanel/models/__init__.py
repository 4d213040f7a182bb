from loadpanel.models.base import Forecaster, ResidualQuantiles
from loadpanel.models.mean import MeanForecaster
from loadpanel.models.ridge import RidgeForecaster
from loadpanel.models.trees import BoostedTreesForecaster, QuantileTreesForecaster

__all__ = [
    "BoostedTreesForecaster",
    "Forecaster",
    "MeanForecaster",
    "QuantileTreesForecaster",
    "ResidualQuantiles",
    "RidgeForecaster",
]
