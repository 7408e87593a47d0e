"""Sizes of batches for a labelling model: pure formulas, and a labeller as an Arrow batch function."""

from __future__ import annotations

from collections.abc import Callable

GIB = 1 << 30


def average_length(bin_name: str) -> float:
    """Middle of a bin like "500_999bp"."""
    lo, hi = bin_name.removesuffix("bp").split("_")
    return (int(lo) + int(hi)) / 2


def dynamic_chunk(chunk: int, bin_name: str) -> int:
    """Reads a chunk: `chunk` for reads of 500 bases, fewer for longer ones, 500 000 at most."""
    return max(1, min(int(chunk * 500 / max(average_length(bin_name), 1)), 500_000))


def memory_of(text: str | None, devices: int) -> list[int]:
    """Bytes of each device from "48" or "48,48,24" (GB; 12 by default). Of a list of the wrong length the first counts for all."""
    values = [float(x) for x in (text or "12").split(",") if x.strip()]
    return [int(v * GIB) for v in (values if len(values) == devices else [values[0]] * devices)]


def usable(total: list[int], in_use: list[int] | None = None, margin: float = 0.35) -> list[int]:
    return [max(0, int(max(0, t - u) * (1 - margin))) for t, u in zip(total, in_use or [0] * len(total), strict=True)]


def by_tokens(length: int, tokens: int = 1_200_000, least: int = 1, most: int = 8192) -> int:
    return least if length <= 0 else max(least, min(most, tokens // int(length)))


def bytes_a_token(embedding: int = 128, filters: int | list[int] = 128, layers: int = 3, units: int | list[int] = 96, both_ways: bool = True, labels: int = 10, overhead: float = 1.12) -> float:
    """Four bytes each for the input, embedding, convolution outputs, recurrent outputs and their four gates, and labels."""
    sides = 1 + both_ways
    conv = sum(filters) if isinstance(filters, list) else filters * layers
    recurrent = sum(units) if isinstance(units, list) else units
    return 4 * (1 + embedding + conv + 5 * recurrent * sides + labels) * overhead


def by_memory(available: list[int], length: int, a_token: float, least: int = 1, most: int = 8192) -> int:
    """What the device with least memory holds."""
    need = max(1, int(a_token * int(length)))
    return min((max(least, min(most, b // need)) if b > 0 else least for b in available), default=least)


def batch_size(length: int, a_token: float, available: list[int] | None, tokens: int = 1_200_000, least: int = 1, most: int = 8192, token_cap_above: int = 0) -> int:
    """Reads in a batch over all devices; None: no device, by tokens alone. Under token_cap_above memory alone decides."""
    budget = by_tokens(length, tokens, least, most)
    if not available:
        return budget
    room = by_memory(available, length, a_token, least, most)
    one = room if 0 < token_cap_above and length < token_cap_above else max(least, min(room, budget))
    return max(1, one * len(available))


def with_backoff(run: Callable[[int], object], start: int, least: int = 1) -> object:
    """run(size), with half the size each time that memory runs out."""
    size = start
    while True:
        try:
            return run(size)
        except MemoryError:
            if size <= least:
                raise
            size = max(least, size // 2)
