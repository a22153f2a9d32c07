"""verdant: sensor telemetry analytics on Apache Spark (DataFrame / SQL / Structured Streaming)."""

try:
    from importlib.metadata import PackageNotFoundError, version

    __version__ = version("verdant")
except PackageNotFoundError:  # running from a source checkout
    __version__ = "0.1.0"
