"""Token-array expressions: templates, guards and previews."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

UINT16_LIMIT = 65_536


def template_single(ids: str | Column, cls_id: int, sep_id: int) -> Column:
    """``[CLS] A [SEP]``"""
    return F.concat(F.array(F.lit(cls_id)), _col(ids), F.array(F.lit(sep_id)))


def template_pair(a: str | Column, b: str | Column, cls_id: int, sep_id: int) -> Column:
    """``[CLS] A [SEP] B [SEP]``"""
    return F.concat(template_single(a, cls_id, sep_id), _col(b), F.array(F.lit(sep_id)))


def pair_type_ids(a: str | Column, b: str | Column) -> Column:
    """0 for ``[CLS] A [SEP]``, 1 for ``B [SEP]``."""
    return F.concat(
        F.array_repeat(F.lit(0), F.size(_col(a)) + 2),
        F.array_repeat(F.lit(1), F.size(_col(b)) + 1),
    )


def drop_ids(ids: str | Column, special: Sequence[int]) -> Column:
    """Remove special ids."""
    return F.filter(_col(ids), lambda x: ~x.isin(*special))


def single_is_valid(ids: str | Column, cls_id: int, sep_id: int) -> Column:
    """First id is CLS and last is SEP."""
    c = _col(ids)
    return (F.size(c) >= 2) & (F.get(c, F.lit(0)) == cls_id) & (
        F.get(c, F.size(c) - 1) == sep_id
    )


def pair_is_valid(ids: str | Column, cls_id: int, sep_id: int) -> Column:
    """First id is CLS and SEP occurs exactly twice."""
    c = _col(ids)
    seps = F.size(F.filter(c, lambda x: x == sep_id))
    return (F.size(c) >= 3) & (F.get(c, F.lit(0)) == cls_id) & (seps == 2)


def fits_uint16(ids: str | Column) -> Column:
    """True when no id would wrap in an unsigned 16-bit array."""
    c = _col(ids)
    low = F.coalesce(F.array_min(c), F.lit(0)) >= 0
    return low & (F.coalesce(F.array_max(c), F.lit(0)) < UINT16_LIMIT)


def preview(ids: str | Column, max_display: int = 50) -> Column:
    """All ids, or the first and last half of ``max_display`` when longer."""
    c = _col(ids)
    half = max_display // 2
    ends = F.concat(F.slice(c, 1, half), F.slice(c, -half, half))
    return F.when(F.size(c) <= max_display, c).otherwise(ends)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind a value to a name, so that lambdas inside ``body`` do not compute it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
