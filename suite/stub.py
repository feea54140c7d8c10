"""A stand-in for a model. It tests the engine's retries and commits, never what a model says."""

from __future__ import annotations

from glossa.plans.scoring import ClientFactory, per_row_client


def stub_client(daily_after: int | None = None) -> ClientFactory:
    """A deterministic stand-in for a model, for tests: it looks at nothing but the request.

    The first hex digit of ``sha256(prompt)`` picks the behaviour: ``0`` per-minute limit
    once, ``1`` server error twice, ``2`` exhausted primary, ``3`` refused, ``4`` not JSON,
    else a reply. ``daily_after`` makes the primary report a daily quota from that ``k`` on.
    """

    def call(request: dict) -> str:
        import hashlib
        import json

        digest = hashlib.sha256(request["prompt"].encode()).hexdigest()
        first, attempt = digest[0], request["attempt"]
        if daily_after is not None and request["model"] == "primary" and request["k"] >= daily_after:
            raise RuntimeError("429 quota exceeded: GenerateRequestsPerDay retry in 14h30m13.78s")
        if first == "0" and attempt == 0:
            raise RuntimeError("429 RESOURCE_EXHAUSTED. Please retry in 1.5s")
        if first == "1" and attempt < 2:
            raise RuntimeError("500 INTERNAL")
        if first == "2" and request["model"] == "primary":
            raise RuntimeError("429 too many requests")
        if first == "3":
            raise RuntimeError("403 permission denied")
        if first == "4":
            return "sorry, no"
        level = ["festive", "LIVELY", "calm", "grim"][int(digest[1], 16) % 4]
        return json.dumps({"mood": level, "caption": digest[:6], "score": int(digest[2], 16)})

    return per_row_client(call, keep_waits=False)
