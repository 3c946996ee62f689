"""Job parameters (the reference's command-line flags, as dataclasses)."""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference job's defaults.
# ---------------------------------------------------------------------------
# Characters removed by the token cleaner (default --filter_char, verbatim; it
# contains a space and a real newline, and some characters more than once).
FILTER_CHARS = """ “”.,?!~！*；。：（）{}【】、-+=？...:;(){}[]，\n//"""
CHAT_THRESHOLD = 0.980          # --chat_filter_score
SPEECH_THRESHOLD = 0.600        # --speech_filter_score
EMOTION_WEIGHTS = (0.8, 0.2)    # model score weight, emotion score weight
SPEECH_MIN_WORDS = 5            # sentences with fewer words are skipped
CHAT_MESSAGE_KEYS = 8           # chat messages with another key count are skipped
SOURCE_CHAT = 1
SOURCE_SPEECH = 2
NO_KEYWORD = "null"             # keyword written when keyword filtering is off
VECTOR_SIZE = 400               # per embedding view
CONTEXT_WINDOW = 10             # words to each side
LR_MAX_ITER = 5000
SVR_MAX_ITER = 1500
FOREST_TREES = 300
FOREST_DEPTH = 50               # Spark caps tree depth at 30; see ml.train
# ---------------------------------------------------------------------------


def yesterday() -> str:
    """Default audit day, resolved once on the driver and passed as a literal."""
    return (_dt.date.today() - _dt.timedelta(days=1)).isoformat()


def days_ago(n: int) -> str:
    return (_dt.date.today() - _dt.timedelta(days=n)).isoformat()


def today() -> str:
    return _dt.date.today().isoformat()


@dataclass(frozen=True)
class AuditConfig:
    """Parameters of the chat and speech audits.

    ``select_mode``: ``intended`` emits the higher of the user's and the agent's
    best sentence (agent on ties); ``faithful`` reproduces the reference's
    branch that always emits the user's pair.
    ``sensitive_mode``: ``substring`` (an entry occurs inside the joined tokens)
    or ``token`` (an entry equals a token).
    """

    prediction_date: str | None = None
    chat_threshold: float = CHAT_THRESHOLD
    speech_threshold: float = SPEECH_THRESHOLD
    emotion_weights: tuple[float, float] = EMOTION_WEIGHTS
    filter_chars: str = FILTER_CHARS
    select_mode: str = "intended"
    sensitive_mode: str = "substring"
    sentence_op: str | None = None   # default: '>' for chat, '>=' for speech
    record_op: str = ">="
    min_words: int = SPEECH_MIN_WORDS
    message_keys: int = CHAT_MESSAGE_KEYS
    han_mode: str = "char"
    max_inline_lexicon: int = 2000   # larger lexicons become an automaton
    max_automaton_chars: int = 4 << 20  # in all their entries; lexicons larger take the join path
    inline: bool = True               # pick the best sentence inside each record's row when possible
    max_inline_canned: int = 10_000   # larger canned tables use the (broadcast) anti-join path

    @property
    def day(self) -> str:
        return self.prediction_date or yesterday()


@dataclass(frozen=True)
class FlowConfig:
    """Parameters of the ticket flow check.

    ``ticket_dates``: inclusive ``(first, last)`` day of tickets to check, or
    ``None`` for every ticket. The reference checks one day (its check date),
    i.e. ``(d, d)``.
    ``call_dates``: inclusive window of call records (``begin_date``, ``end_date``),
    or ``None`` for all.
    ``check_date``: the day the run checks; it names the run's output and, where call
    records carry a compute date, restricts them to it.
    """

    ticket_dates: tuple[str, str] | None = None
    call_dates: tuple[str, str] | None = None
    is_keyword: bool = True
    max_broadcast_bytes: int = 64 << 20
    check_date: str | None = None

    @staticmethod
    def for_day(day: str | None = None, begin: str | None = None, end: str | None = None) -> "FlowConfig":
        d = day or yesterday()
        return FlowConfig(ticket_dates=(d, d), call_dates=(begin or d, end or today()), check_date=d)
