"""Checkpoint locations and triggers."""

from __future__ import annotations

from typing import Any


def checkpoint_uri(storage: str, path: str, namenode: str | None = None, bucket: str | None = None) -> str:
    """Folder for stream progress and state on ``hdfs``, ``s3`` or ``local`` storage.

    Local storage is for one machine only; a cluster needs one of the shared ones.
    """
    kind = storage.strip().lower()
    if kind == "hdfs":
        if not namenode or not namenode.strip():
            raise ValueError("hdfs checkpoints need a namenode")
        return f"{namenode.strip().rstrip('/')}/{path.lstrip('/')}"
    if kind == "s3":
        if not bucket or not bucket.strip():
            raise ValueError("s3 checkpoints need a bucket")
        return f"s3a://{bucket.strip()}/{path.lstrip('/')}"
    if kind == "local":
        if not path or not path.strip():
            raise ValueError("local checkpoints need a path")
        return path if path.startswith("file://") else f"file://{path}"
    raise ValueError(f"unknown checkpoint storage '{storage}': use hdfs, s3 or local")


def trigger(interval: str | None) -> dict[str, Any]:
    """Micro-batches every ``interval``; None drains what is there and stops."""
    return {"processingTime": interval} if interval else {"availableNow": True}
