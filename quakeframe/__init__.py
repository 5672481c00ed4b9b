"""quakeframe: earthquake catalogue and live event analytics on PySpark."""

__version__ = "0.1.0"
