"""A PySpark engine for building, scoring and quality-gating paired speech-data manifests."""
