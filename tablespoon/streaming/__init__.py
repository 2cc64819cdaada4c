from .landing import ingest_landing

__all__ = ["ingest_landing"]
