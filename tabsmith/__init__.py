"""tabsmith: tabular preparation, modelling and scoring as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
