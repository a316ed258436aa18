"""Vehicle-telematics and auto-insurance analytics as PySpark DataFrame operators."""

__version__ = "0.1.0"
