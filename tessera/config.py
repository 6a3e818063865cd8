"""Options shared by the operators.

Defaults follow the reference's configuration; unknown names are rejected
instead of being silently attached.
"""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Config:
    # Fixed values that must equal the reference's defaults.
    block_size: int = 256
    step_size: int | None = None  # None means block_size
    batch_size: int = 32
    max_iters: int = 10000
    eval_interval: int = 1000
    train_ratio: float = 0.9
    temperature: float = 1.0
    top_p: float = 0.9
    repetition_penalty: float = 1.2
    patience_early_stopping: int = 5
    prompt_format: str = "Q: {question} A: {answer}"
    max_generate_length: int = 100
    generation_batch_size: int = 4
    vocab_size: int = 10000
    pad_id: int = 0
    unk_id: int = 1
    bos_id: int = 2
    eos_id: int = 3
    # Our own options.
    seed: int = 42
    ngram_order: int = 3
    ngram_lambdas: tuple = field(default=(0.01, 0.19, 0.3, 0.5))
    penalty_mode: str = "sign_aware"

    def __post_init__(self):
        if self.step_size is None:
            object.__setattr__(self, "step_size", self.block_size)
        self.validate()

    @classmethod
    def of(cls, **overrides) -> "Config":
        known = {f.name for f in dataclasses.fields(cls)}
        unknown = sorted(set(overrides) - known)
        if unknown:
            raise ValueError(f"unknown option(s): {', '.join(unknown)}")
        return cls(**overrides)

    def replace(self, **overrides) -> "Config":
        known = {f.name for f in dataclasses.fields(self)}
        unknown = sorted(set(overrides) - known)
        if unknown:
            raise ValueError(f"unknown option(s): {', '.join(unknown)}")
        return dataclasses.replace(self, **overrides)

    def validate(self) -> None:
        if not 0 <= self.train_ratio <= 1:
            raise ValueError("train_ratio must be between 0 and 1")
        if not 0 <= self.top_p <= 1:
            raise ValueError("top_p must be between 0 and 1")
        for name in ("block_size", "step_size", "batch_size", "max_generate_length",
                     "generation_batch_size", "eval_interval", "patience_early_stopping"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be a positive value")
        if self.temperature <= 0:
            raise ValueError("temperature must be a positive value")
        if self.repetition_penalty <= 0:
            raise ValueError("repetition_penalty must be a positive value")
        if self.vocab_size <= 4:
            raise ValueError("vocab_size must exceed the four special tokens")
        if self.ngram_order < 1 or len(self.ngram_lambdas) != self.ngram_order + 1:
            raise ValueError("ngram_lambdas needs one weight per order plus the uniform floor")
        if any(x < 0 for x in self.ngram_lambdas) or sum(self.ngram_lambdas) <= 0:
            raise ValueError("ngram_lambdas must be non-negative with a positive sum")
        if self.penalty_mode not in ("divide", "sign_aware"):
            raise ValueError("penalty_mode is 'divide' or 'sign_aware'")
