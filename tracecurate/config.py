"""Parameters of a curation run."""

from __future__ import annotations

from dataclasses import dataclass

from .functions.instructions import GENERATE_SYSTEM, JUDGE_SYSTEM

# --- fixed values: trace states, phrases and keys that decide which rows survive ---
SUCCESS_STATES = ("OK", "TRACE_STATE_OK")
HOUSEKEEPING_PHRASES = (
    "review the conversation above",
    "update the skill library",
    "a pass that does nothing",
)
SESSION_KEY = "mlflow.trace.session"
ATTRIBUTE_WORDS = ("message", "prompt", "completion", "input", "output", "gen_ai", "llm")
# --- end of fixed values ---


@dataclass(frozen=True)
class ChatTemplate:
    """Wrapper strings of the ChatML chat format; the defaults are the public Qwen2 ones."""

    turn_open: str = "<|im_start|>"
    turn_close: str = "<|im_end|>\n"
    default_system: str | None = "You are a helpful assistant."


@dataclass(frozen=True)
class CurationConfig:
    # instructions to the model; the answers keep their grammar (see functions/prompts.py)
    judge_system: str = JUDGE_SYSTEM
    generate_system: str = GENERATE_SYSTEM

    # what to read and keep
    max_traces: int | None = None
    success_states: tuple[str, ...] = SUCCESS_STATES
    housekeeping_phrases: tuple[str, ...] = HOUSEKEEPING_PHRASES
    session_key: str = SESSION_KEY
    parse_json_strings: bool = False
    score_threshold: int = 7
    copies: int = 5

    # completion settings per stage
    judge_temperature: float = 0.0
    judge_max_tokens: int = 1024
    generate_temperature: float = 0.8
    generate_max_tokens: int = 8192
    eval_max_tokens: int = 512
    seed_temperature: float = 1.0
    seed_max_tokens: int = 4096
    # Calls in flight in each task, tasks, jobs that are committed one by one, and tries.
    concurrency: int = 8
    call_tasks: int = 8
    call_waves: int = 4
    attempts: int = 3
    # Calls that all tasks together may begin in a second; None for any number.
    calls_per_second: float | None = None

    # splits and training plan
    holdout_fraction: float = 0.1
    validation_fraction: float = 0.1
    seed: int = 42
    max_sequence_tokens: int = 2048
    epochs: int = 3
    batch_size: int = 4
    gradient_accumulation: int = 2

    # A session with more turns than this is not handled by one window task. Numbering
    # is linear in the session, a full history is quadratic, hence two limits.
    hot_session_turns: int = 1_000_000
    long_history_turns: int = 1_000
    history_block_turns: int = 200
    # Most rows a lookup table may have to be broadcast; a larger one is shuffled.
    broadcast_rows: int = 100_000
