"""Run stamps: computed once on the driver, passed to operators as literals."""

from __future__ import annotations

from datetime import datetime, timezone


def utc_now() -> datetime:
    """Current UTC time without zone (the reference stamps naive UTC)."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def iso_stamp(t: datetime | str) -> str:
    """ISO-8601 form used for ``fetch_timestamp`` / ``ingestion_timestamp``."""
    return t if isinstance(t, str) else t.isoformat()


def compact_stamp(t: datetime | str) -> str:
    """``yyyyMMdd_HHmmss`` form used for run names and report stamps."""
    return t if isinstance(t, str) else t.strftime("%Y%m%d_%H%M%S")


def default_batch_id(ingested_at: datetime, prefix: str = "batch") -> str:
    return f"{prefix}_{compact_stamp(ingested_at)}"
