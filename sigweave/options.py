"""Options of a streaming job."""

from dataclasses import dataclass, field

from sigweave.operators.skew import Skew
from sigweave.schema import TTL_SECONDS


@dataclass(frozen=True)
class JobOptions:
    """checkpoint: folder for positions and state, shared by all executors.

    ttl: how long a message waits. session_ttl: how long a session lives. delay: how late a
    message may come, in seconds of event time. trigger: seconds between micro-batches, None
    to read what is there and stop. carry_all: carry every optional field, not identity only.
    idle_after: seconds without news after which the clock goes on with the time of day; None to
    wait for messages. A stream started with it must be started with it again. dedup: publish a key once
    in each span of so many seconds of event time; None to publish every pair. compact_every: steps
    after which changes of state are put together. pairing: "next" pairs a message with the next of its key,
    "response" each request with the first response that follows.
    """

    checkpoint: str
    pair_out: str
    unpaired_out: str
    ttl: float = TTL_SECONDS
    session_ttl: float = TTL_SECONDS
    delay: float = 10.0
    trigger: float | None = 1.0
    carry_all: bool = False
    max_ahead: float = 86_400.0
    idle_after: float | None = None
    dedup: float | None = None
    compact_every: int = 16
    pairing: str = "next"
    output_format: str = "rows"
    unpaired_format: str = "rows"
    source: str = "messages"
    location: str = ""
    servers: str = ""
    pair_topic: str | None = None
    unpaired_topic: str | None = None
    ledger: str | None = None
    max_per_trigger: int | None = None
    skew: Skew = field(default_factory=Skew)
