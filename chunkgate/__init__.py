"""chunkgate: validate, identify, split, model, gate and score arriving data chunks on Spark."""

__version__ = "0.1.0"
