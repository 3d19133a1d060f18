"""One place for the parameters a run needs."""

from __future__ import annotations

from dataclasses import dataclass, field

# Default mixing weights with and without external corpora, and the
# per-source fallback for a weight that a caller's dictionary leaves out.
WEIGHTS_WITH_EXTERNAL = {"generated": 0.20, "external": 0.70, "personality": 0.10}
WEIGHTS_WITHOUT_EXTERNAL = {"generated": 0.90, "external": 0.00, "personality": 0.10}
WEIGHT_FALLBACK = {"generated": 0.2, "external": 0.7, "personality": 0.1}

# Fixed value: label of a token that the loss ignores.
IGNORED_LABEL = -100


@dataclass(frozen=True)
class ChatTemplate:
    """Text around one message. The defaults are the public ChatML format.

    A template must open every message with a token of its own, so that encoding message by
    message gives the same ids as encoding the whole rendered conversation.
    """

    before_role: str = "<|im_start|>"
    after_role: str = "\n"
    after_content: str = "<|im_end|>\n"
    generation: str = "<|im_start|>assistant\n"


@dataclass(frozen=True)
class Settings:
    target_megachats: int = 4200
    mega_size: int = 8
    max_seq_len: int = 4096
    seed: int = 3407
    test_fraction: float = 0.01
    eos_id: int | None = None
    system_prompt: str = ""
    weights: dict[str, float] | None = None
    template: ChatTemplate = field(default_factory=ChatTemplate)
