"""Slow, obvious versions of operators, to compare with."""

from __future__ import annotations

import hashlib

from sparkprep.operators.chunk import DUPLICATE, LOSSLESS, MOVE, NO_BACKFILL, ChunkConfig


def draw(seed: int, key: str) -> int:
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


def closed(ids: list[int], c: ChunkConfig, spaced=list) -> list[int]:
    """One chunk with its special ids, in the reference length rules."""
    ids = spaced(ids)
    out = ids if ids and ids[0] == c.bos_id else [c.bos_id, *ids]
    out = out[: max(0, c.chunk_size - (1 if c.eos_id is None else 2))]
    if c.eos_id is not None and out and out[-1] != c.eos_id:
        out = [*out, c.eos_id]
    return out


def chunks(
    ids: list[int], c: ChunkConfig, key: str, reencode=None
) -> tuple[list[list[int]], int, int]:
    """Piece by piece, keeping the list of chunks so far.

    ``reencode`` is the prefix-space step, for chunks that do not open with BOS.
    """

    def spaced(x):
        if reencode is None or (x and x[0] == c.bos_id):
            return list(x)
        return reencode(x)[: c.chunk_size - 2]

    lossless = c.specials == LOSSLESS
    ids = list(ids)
    if lossless:
        if ids and ids[0] == c.bos_id:
            ids = ids[1:]
        if ids and ids[-1] == c.eos_id:
            ids = ids[:-1]
    elif c.add_eos and ids and ids[-1] != c.eos_id:
        ids = [*ids, c.eos_id]
    width = c.chunk_size - 2
    if width <= 0:
        return [], 0, len(ids)
    wrap = spaced if lossless else (lambda x: closed(list(x), c, spaced))
    bare = (lambda x: x) if lossless else (lambda x: x[1:])
    out: list[list[int]] = []
    duplicated = skipped = 0
    for start in range(0, len(ids), width):
        part = ids[start : start + width]
        later = start > 0
        if later and len(part) < c.skip_size:
            skipped += len(part)
        elif later and len(part) < c.min_chunk_size:
            if c.backfill == NO_BACKFILL:
                skipped += len(part)
                continue
            source = bare(out[-1])
            room = min(width - len(part), len(source))
            if c.backfill == DUPLICATE:
                duplicated += room
                out.append(wrap(source[len(source) - room :] + part))
            else:
                moved = draw(c.seed, key) % (room + 1)
                if moved:
                    out[-1] = wrap(source[:-moved])
                out.append(wrap((source[-moved:] if moved else []) + part))
        else:
            out.append(wrap(part))
    if lossless:
        tail = [] if c.eos_id is None else [c.eos_id]
        out = [[c.bos_id, *x, *tail] for x in out]
    return out, duplicated, skipped


MODES = (NO_BACKFILL, DUPLICATE, MOVE)
