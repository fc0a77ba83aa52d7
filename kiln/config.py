"""Frozen settings for every stage (plain values; no YAML loader needed)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class FilterConfig:
    # Thresholds of the quality filter.
    min_chars: int = 200
    max_chars: int = 1_000_000
    max_symbol_ratio: float = 0.2
    min_token_count: int = 20
    max_token_count: int = 100_000
    max_repeat_char: int = 10
    max_repeated_line_ratio: float = 0.3


@dataclass(frozen=True)
class DedupConfig:
    shingle_size: int = 5
    num_perm: int = 128
    similarity_threshold: float = 0.85
    # Bands and rows per band; where not given, the best ones for threshold and permutations (8 x 16 here).
    bands: int | None = None
    rows: int | None = None
    seed: int = 1

    def __post_init__(self) -> None:
        from kiln.operators.bands import band_parameters

        if (self.bands is None) != (self.rows is None):
            raise ValueError("give bands and rows together, or neither")
        if self.bands is None:
            bands, rows = band_parameters(self.similarity_threshold, self.num_perm)
            object.__setattr__(self, "bands", bands)
            object.__setattr__(self, "rows", rows)


@dataclass(frozen=True)
class TokenizerConfig:
    vocab_size: int = 16_000
    min_frequency: int = 2
    # Reserved special tokens, ids 0..3 in this order.
    special_tokens: tuple[str, ...] = ("<pad>", "<bos>", "<eos>", "<unk>")
    max_token_length: int = 32
    heldout_split: float = 0.1
    # Seed all 256 bytes into the alphabet so that no byte is unknown.
    seed_all_bytes: bool = True


@dataclass(frozen=True)
class PackConfig:
    block_size: int = 1024
    train_split: float = 0.99
    pad_id: int = 0
    bos_id: int = 1
    eos_id: int = 2
    unk_id: int = 3


@dataclass(frozen=True)
class IngestConfig:
    prefix: str = "doc"
    shard_size: int = 10_000
    target_tokens: int | None = None
    target_docs: int | None = None
    schema_version: int = 1
    extra: dict = field(default_factory=dict)
