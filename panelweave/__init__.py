"""panelweave: build, clean, label, model and score panels of time series on Spark."""

__version__ = "0.1.0"
