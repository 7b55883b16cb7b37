"""filelake: keep a large file collection mirrored, indexed and searchable with Spark."""

__version__ = "0.1.0"
