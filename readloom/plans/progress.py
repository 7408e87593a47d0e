"""Progress of a long annotation: which chunk was done last, and what a resumed run clears away.

Spark tasks commit their output whole, so a run that writes tables needs none of this; it serves jobs that go bin by bin.
"""

from __future__ import annotations

import re
import warnings
from pathlib import Path


def save(path: str, passed: int, bin_name: str, chunk: int, size: int) -> None:
    Path(path).write_text(f"{passed}\t{bin_name}\t{chunk}\t{size}\n")


def load(path: str, size: int | None = None) -> tuple[int, str, int] | None:
    """(pass, bin, chunk), or None if there is no readable line. Another chunk size than `size` is an error; lines without one are taken with a warning."""
    file = Path(path)
    parts = file.read_text().split("\n")[0].strip().split("\t") if file.exists() else []
    if len(parts) not in (3, 4) or not re.fullmatch(r"-?\d+", parts[0]) or not all(re.fullmatch(r"-?\d+", x) for x in parts[2:]):
        return None
    if size is not None:
        if len(parts) == 3:
            warnings.warn("checkpoint without a chunk size; it can't be compared", stacklevel=2)
        elif int(parts[3]) != size:
            raise ValueError(f"chunk_size mismatch: the checkpoint has {parts[3]}, this run {size}")
    return int(parts[0]), parts[1], int(parts[2])


def marker(folder: str, passed: int, bin_name: str, chunk: int) -> Path:
    return Path(folder) / f"pass{passed}_{bin_name}_chunk{chunk}.done"


def rewind(folder: str, at: tuple[int, str, int] | None) -> tuple[int, str, int] | None:
    """The checkpoint, or the chunk before it if its marker is missing."""
    if at is None or marker(folder, *at).exists():
        return at
    return (at[0], at[1], at[2] - 1) if at[2] > 0 else None


def clear_after(folder: str, at: tuple[int, str, int] | None, order: list[str]) -> list[str]:
    """Removes files of chunks after the checkpoint, all without one; gives their names."""
    gone = []
    for file in sorted(Path(folder).glob("pass*_chunk*")):
        m = re.match(r"pass(\d+)_(.+?bp)_chunk(\d+)", file.name)
        key = (int(m[1]), order.index(m[2]) if m[2] in order else len(order), int(m[3])) if m else None
        last = (at[0], order.index(at[1]) if at[1] in order else len(order), at[2]) if at else None
        if key and (last is None or key > last):
            file.unlink()
            gone.append(file.name)
    return gone
