"""Job settings read from the environment, with defaults (one frozen object)."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from verdant import schemas as S
from verdant.sinks.upsert import COMPACT_EVERY


def _split(text: str) -> tuple[str, ...]:
    return tuple(t.strip() for t in text.split(",") if t.strip())


@dataclass(frozen=True)
class JobOptions:
    bootstrap_servers: str = "localhost:9092"
    topics: tuple[str, ...] = S.ALL_TOPICS
    starting_offsets: str = "latest"
    # Root for stream checkpoints; None -> "<spark.checkpoint.dir>/streams".
    checkpoint_root: str | None = None
    # Root for the keyed aggregate tables; None -> "<spark.checkpoint.dir>/tables".
    table_root: str | None = None
    window: str = S.WINDOW_DURATION
    watermark: str = S.WATERMARK_DELAY
    # None = default trigger (next batch as soon as the previous ends).
    processing_time: str | None = None
    max_offsets_per_trigger: int | None = None
    # A rejects query reads the source a third time; opt in.
    write_rejects: bool = False
    # One query for both tables: one read of the source, one commit for both.
    shared_tables: bool = False
    # Compact each table after every N-th micro-batch (None, or COMPACT_EVERY=0: never from the stream).
    compact_every: int | None = COMPACT_EVERY
    extra_source_options: Mapping[str, str] = field(default_factory=dict, hash=False)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JobOptions:
        env = os.environ if env is None else env
        base = cls()

        def get(name, default):  # an empty variable counts as unset
            value = (env.get(name) or "").strip()
            return value or default

        extra = {}
        if get("KAFKA_MIN_PARTITIONS", None):
            extra["minPartitions"] = get("KAFKA_MIN_PARTITIONS", None)
        return replace(
            base,
            bootstrap_servers=get("KAFKA_BOOTSTRAP", base.bootstrap_servers),
            topics=_split(get("KAFKA_TOPICS", "")) or base.topics,
            starting_offsets=get("STARTING_OFFSETS", base.starting_offsets),
            checkpoint_root=get("CHECKPOINT_DIR", base.checkpoint_root),
            table_root=get("TABLE_ROOT", base.table_root),
            window=get("WINDOW_DURATION", base.window),
            watermark=get("WATERMARK_DELAY", base.watermark),
            processing_time=get("TRIGGER_INTERVAL", base.processing_time),
            max_offsets_per_trigger=int(get("MAX_OFFSETS_PER_TRIGGER", 0)) or None,
            write_rejects=get("WRITE_REJECTS", "0").lower() in ("1", "true", "yes"),
            shared_tables=get("SHARED_TABLES", "0").lower() in ("1", "true", "yes"),
            compact_every=int(get("COMPACT_EVERY", base.compact_every)) or None,
            extra_source_options=extra,
        )
