"""pvscan: large-rooftop-solar detection as PySpark DataFrame plans."""

__version__ = "0.1.0"
