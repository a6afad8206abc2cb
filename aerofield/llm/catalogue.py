"""All queries and oracle statements of this folder."""

from __future__ import annotations

from . import chat, decontaminate, language, mixing, pitman_yor, simhash, suffix_dedup, token_counts, token_ids, topk

MODULES = (topk, token_counts, pitman_yor, mixing, decontaminate, token_ids, simhash, language, chat, suffix_dedup)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracles() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
