"""Settings of a run, with checks, and from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

#: Environment variables are this prefix and a setting's name in capitals.
PREFIX = "FOLIATE_"


@dataclass(frozen=True)
class Settings:
    """Where a run reads and writes, and the limits of its steps. Distances are page fractions."""

    raw_dir: str = "data/raw"
    processed_dir: str = "data/processed"
    chunk_tokens: int = 300
    chunk_overlap: int = 0
    embedding_model: str = ""
    nearby_distance: float = 0.08
    top_k: int = 3
    least_similarity: float = 0.75

    def __post_init__(self):
        if self.chunk_tokens <= 0:
            raise ValueError("chunk_tokens must be positive")
        if not 0 <= self.chunk_overlap < self.chunk_tokens:
            raise ValueError("chunk_overlap must be at least 0 and less than chunk_tokens")
        if self.top_k <= 0 or self.nearby_distance < 0 or not -1 <= self.least_similarity <= 1:
            raise ValueError("top_k, nearby_distance or least_similarity is out of range")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Settings:
        """Settings with what the environment sets; blank values count as unset, bad numbers are errors."""
        env = os.environ if env is None else env
        found = {}
        for f in fields(cls):
            value = env.get(PREFIX + f.name.upper(), "").strip()
            if value:
                try:
                    found[f.name] = type(f.default)(value)
                except ValueError as e:
                    raise ValueError(f"{PREFIX}{f.name.upper()}: {value!r} is no {type(f.default).__name__}") from e
        return cls(**found)
