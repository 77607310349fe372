"""Cut token arrays into fixed-length training sequences.

Only the last piece of a document can be shorter than the window, and only it
and the piece before it interact, so every chunk follows from the document
length by arithmetic. A document becomes one row per window by exploding the
slices of its windows in place; the other array work happens in projections
after that, so nothing is shuffled and nothing loops over a document.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.arrays import let
from sparkprep.functions.draws import draw_int
from sparkprep.functions.groups import named, rollup_sums

NO_BACKFILL = "none"
DUPLICATE = "duplicate"
MOVE = "move"

REFERENCE = "reference"
LOSSLESS = "lossless"


@dataclass(frozen=True)
class ChunkConfig:
    """How to cut.

    ``backfill`` fills a short last piece from the piece before it: ``duplicate``
    copies ids, ``move`` takes a seeded random number of them away from it.
    ``specials='reference'`` keeps the established length rules, under which a
    full chunk that gains a BOS loses its last token; ``'lossless'`` wraps bare
    content and loses nothing.
    """

    chunk_size: int
    bos_id: int
    eos_id: int | None = None
    min_chunk_size: int = 512
    always_skip_size: int | None = None
    min_sample_tokens: int = 0
    backfill: str = MOVE
    add_eos: bool = False
    specials: str = REFERENCE
    seed: int = 42

    def __post_init__(self) -> None:
        if self.backfill not in (NO_BACKFILL, DUPLICATE, MOVE):
            raise ValueError(f"unknown backfill mode {self.backfill!r}")
        if self.specials not in (REFERENCE, LOSSLESS):
            raise ValueError(f"unknown specials mode {self.specials!r}")
        if self.add_eos and self.eos_id is None:
            raise ValueError("add_eos needs an eos_id")

    @property
    def window(self) -> int:
        """Content ids per chunk: two places stay free for the special ids."""
        return self.chunk_size - 2

    @property
    def skip_size(self) -> int:
        """Later pieces shorter than this are always dropped."""
        if self.always_skip_size is not None:
            return self.always_skip_size
        return 32 if self.chunk_size >= 8192 else 128

    @property
    def wrapped_limit(self) -> int:
        """Longest BOS + content before the closing EOS, in reference mode."""
        return self.chunk_size - 2 if self.eos_id is not None else self.chunk_size - 1


def preset(chunk_size: int, bos_id: int, eos_id: int | None, **changes: object) -> ChunkConfig:
    """The two documented configurations, for 1,024 and 4,096 ids."""
    # chunk_size -> (min_chunk_size, always_skip_size, min_sample_tokens)
    known = {1024: (512, 128, 2), 4096: (1024, 128, 2048)}
    if chunk_size not in known:
        raise ValueError(f"no preset for chunk size {chunk_size}; known: {sorted(known)}")
    low, skip, sample = known[chunk_size]
    options = {"min_chunk_size": low, "always_skip_size": skip, "min_sample_tokens": sample}
    return ChunkConfig(chunk_size, bos_id, eos_id, **{**options, **changes})


def sample_size(df: DataFrame, ids: str = "input_ids") -> Column:
    """The stored ``len`` where there is one, else the number of ids."""
    return F.col("len") if "len" in df.columns else F.size(ids)


def keep_long_samples(df: DataFrame, min_tokens: int, ids: str = "input_ids") -> DataFrame:
    """Drop samples with fewer than ``min_tokens`` ids.

    A stored ``len`` is compared in the scan; the arrays of dropped samples are
    never decoded.
    """
    return df.where(sample_size(df, ids) >= min_tokens)


def append_eos(ids: Column, eos_id: int) -> Column:
    """Close a non-empty sequence with EOS unless it already ends with it."""
    missing = (F.size(ids) > 0) & (F.get(ids, F.size(ids) - 1) != eos_id)
    return F.when(missing, F.concat(ids, F.array(F.lit(eos_id)))).otherwise(ids)


def wrap_specials(ids: Column, cfg: ChunkConfig) -> Column:
    """BOS in front and EOS at the end, within the length limit of the mode."""
    eos = F.array() if cfg.eos_id is None else F.array(F.lit(cfg.eos_id))
    eos = eos.cast("array<int>")
    bos = F.array(F.lit(cfg.bos_id))
    if cfg.specials == LOSSLESS:
        return F.concat(bos, ids, eos)

    has_bos = F.coalesce(F.get(ids, F.lit(0)) == cfg.bos_id, F.lit(False))
    limit = max(0, cfg.wrapped_limit)
    room = F.when(has_bos, limit).otherwise(max(0, limit - 1))
    nothing = F.array().cast("array<int>")
    lead = F.when(has_bos, nothing).otherwise(bos) if limit else nothing
    close = eos
    if cfg.eos_id is not None:
        taken = F.least(F.size(ids), room)
        last = F.when(taken > 0, F.get(ids, taken - 1)).otherwise(F.lit(cfg.bos_id))
        close = F.when(last == cfg.eos_id, nothing).otherwise(eos)
    return F.concat(lead, F.slice(ids, F.lit(1), room), close)


def with_chunk_plan(
    df: DataFrame, cfg: ChunkConfig, *, key: Sequence[str] = ("id",), ids: str = "input_ids"
) -> DataFrame:
    """Per-document numbers that decide every chunk.

    Adds ``tokens`` (the ids to cut), ``n_windows``, ``tail`` (length of the
    last window), ``keep_full`` and ``keep_tail`` (are windows after the first
    kept), ``fill`` (is the tail backfilled), ``n_chunks`` and ``skipped``.
    """
    tokens = F.col(ids)
    if cfg.specials == LOSSLESS:
        tokens = _bare(tokens, cfg)
    if cfg.add_eos and cfg.specials == REFERENCE:
        tokens = append_eos(tokens, cfg.eos_id)
    b = cfg.window
    planned = df.withColumn("tokens", tokens).withColumn("n_tokens", F.size("tokens"))
    if b <= 0:
        return planned.select(
            "*",
            F.lit(0).alias("n_windows"),
            F.lit(0).alias("tail"),
            F.lit(False).alias("keep_full"),
            F.lit(False).alias("keep_tail"),
            F.lit(False).alias("fill"),
            F.lit(0).alias("n_chunks"),
            F.col("n_tokens").alias("skipped"),
        )
    backfills = cfg.backfill != NO_BACKFILL
    keep_full = b >= cfg.skip_size and (b >= cfg.min_chunk_size or backfills)
    n, r = F.col("n_windows"), F.col("tail")
    short = r < cfg.min_chunk_size
    keep_tail = (r >= cfg.skip_size) & (~short | F.lit(backfills))
    planned = (
        planned.withColumn("n_windows", F.ceil(F.col("n_tokens") / F.lit(b)).cast("int"))
        .withColumn("tail", F.col("n_tokens") - (n - 1) * F.lit(b))
        .withColumn("keep_full", F.lit(keep_full))
        .withColumn("keep_tail", (n > 1) & keep_tail)
        .withColumn("fill", F.col("keep_tail") & short & F.lit(backfills))
    )
    middle = F.greatest(n - 2, F.lit(0))
    return planned.withColumn(
        "n_chunks",
        F.when(n == 0, 0).otherwise(
            1 + middle * F.lit(int(keep_full)) + F.col("keep_tail").cast("int")
        ),
    ).withColumn(
        "skipped",
        F.when(n < 2, 0).otherwise(
            middle * F.lit(0 if keep_full else b) + F.when(F.col("keep_tail"), 0).otherwise(r)
        ),
    )


def chunk_windows(
    df: DataFrame,
    cfg: ChunkConfig,
    *,
    key: Sequence[str] = ("id",),
    ids: str = "input_ids",
    keep_empty: bool = False,
    reencode: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """One row per kept chunk, with the counters of its document alongside.

    ``reencode(df, column)`` is the optional prefix-space step: it gets an array
    column and replaces each non-null array by one that starts with a space.
    ``keep_empty`` also returns documents that give no chunk (null
    ``chunk_idx``), which the statistics need.
    """
    b = cfg.window
    planned = with_chunk_plan(df, cfg, key=key, ids=ids).drop(ids)
    windows = F.when(F.col("n_windows") > 0, F.sequence(F.lit(0), F.col("n_windows") - 1))
    wanted = F.filter(
        windows,
        lambda i: (i == 0)
        | F.when(i == F.col("n_windows") - 1, F.col("keep_tail")).otherwise(F.col("keep_full")),
    )
    explode = F.explode_outer if keep_empty else F.explode
    n = F.col("n_windows")

    # Each window takes its slices before the explode, so that a row carries its own
    # ids and not the document's: the work is linear in the document.
    def window(tokens: Column, i: Column) -> Column:
        is_tail = F.col("fill") & (i == n - 1)
        # With "move", the window before the tail gives ids away and shrinks.
        gives = F.col("fill") & (i == n - 2) & F.lit(cfg.backfill == MOVE)
        start = F.when(is_tail, i - 1).otherwise(i) * F.lit(b) + 1
        return F.struct(
            i.alias("window_idx"),
            is_tail.alias("_is_tail"),
            gives.alias("_gives"),
            F.slice(tokens, start, F.lit(b)).alias("_base"),
            F.when(is_tail, F.slice(tokens, i * F.lit(b) + 1, F.lit(b))).alias("_own"),
        )

    cut = let(F.col("tokens"), lambda t: F.transform(wanted, lambda i: window(t, i)))
    kept = [c for c in planned.columns if c != "tokens"]
    rows = planned.select(*kept, explode(cut).alias("_window")).select(*kept, "_window.*")
    i = F.col("window_idx")
    if reencode:
        rows = _reencoded(rows, "_base", cfg, reencode)

    lossless = cfg.specials == LOSSLESS
    wrapped = F.col("_base") if lossless else wrap_specials(F.col("_base"), cfg)
    rows = rows.withColumn("_wrapped", F.when(i.isNotNull(), wrapped)).drop("_base")
    body = F.col("_wrapped") if lossless else F.slice("_wrapped", F.lit(2), F.size("_wrapped"))
    rows = rows.withColumn("_body", F.when(F.col("_is_tail") | F.col("_gives"), body))
    room = F.least(F.lit(b) - F.col("tail"), F.size("_body"))
    amount = room
    if cfg.backfill == MOVE:
        amount = F.when(room > 0, F.pmod(draw_int(cfg.seed, *key), room + 1)).otherwise(0)
    rows = rows.withColumn("_moved", F.when(F.col("_body").isNotNull(), amount.cast("int")))

    moved = F.col("_moved")
    from_end = F.slice("_body", F.size("_body") - moved + 1, moved)
    remainder = F.slice("_body", F.lit(1), F.size("_body") - moved)
    rows = rows.withColumn(
        "_content",
        F.when(F.col("_is_tail"), F.concat(from_end, F.col("_own"))).when(
            F.col("_gives") & (moved > 0), remainder
        ),
    ).drop("_own", "_body")
    if reencode:
        rows = _reencoded(rows, "_content", cfg, reencode)
    if lossless:
        final = wrap_specials(F.coalesce("_content", "_wrapped"), cfg)
    else:
        final = F.coalesce(wrap_specials(F.col("_content"), cfg), F.col("_wrapped"))

    # Each document's own counters appear once, on its first row.
    first = i.isNull() | (i == 0)
    duplicated = F.lit(0)
    if cfg.backfill == DUPLICATE:
        duplicated = F.when(F.col("_is_tail"), moved).otherwise(0)
    index = F.when(i == 0, 0).when(F.lit(True) & F.col("keep_full"), i).otherwise(
        F.when(i.isNotNull(), 1)
    )
    return (
        rows.withColumn("chunk_idx", index.cast("int"))
        .withColumn("input_ids", F.when(i.isNotNull(), final))
        .withColumn("len", F.size("input_ids"))
        .withColumn("below_min", F.col("len") < cfg.min_chunk_size)
        .withColumn("duplicated_tokens", duplicated)
        .withColumn("skipped_tokens", F.when(first, F.col("skipped")).otherwise(0))
        .withColumn("input_samples", F.when(first, 1).otherwise(0))
        .drop(
            "_is_tail", "_gives", "_wrapped", "_moved", "_content", "n_windows", "tail",
            "keep_full", "keep_tail", "fill", "n_chunks", "skipped", "window_idx", "n_tokens",
        )
    )


def chunk_dataset(
    df: DataFrame,
    cfg: ChunkConfig,
    *,
    key: Sequence[str] = ("id",),
    keep: Sequence[str] = ("dataset", "subset"),
    ids: str = "input_ids",
    reencode: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Filter short samples and cut the rest.

    Columns: ``keep + key, chunk_idx, input_ids, len, below_min`` and the counters
    ``duplicated_tokens`` and ``skipped_tokens``, which let the statistics be read
    from the written chunks. ``skipped_tokens`` stands on a document's first chunk.
    """
    source = keep_long_samples(df, cfg.min_sample_tokens, ids).select(*keep, *key, ids)
    rows = chunk_windows(source, cfg, key=key, ids=ids, reencode=reencode)
    return rows.select(
        *keep,
        *key,
        "chunk_idx",
        "input_ids",
        "len",
        "below_min",
        "duplicated_tokens",
        "skipped_tokens",
    )


def chunk_stats(
    df: DataFrame,
    cfg: ChunkConfig,
    *,
    by: Sequence[str] = ("subset",),
    key: Sequence[str] = ("id",),
    ids: str = "input_ids",
    reencode: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Counters per group and overall (null group), in one pass and one small shuffle."""
    short = sample_size(df, ids) < cfg.min_sample_tokens
    source = df.select(*by, *key, ids, short.alias("_short"))
    # A short sample is cut as an empty one: it keeps its row and gives no chunk.
    source = source.withColumn(
        ids, F.when(F.col("_short"), F.array().cast("array<int>")).otherwise(F.col(ids))
    )
    rows = chunk_windows(source, cfg, key=key, ids=ids, keep_empty=True, reencode=reencode)
    whole = F.when(F.col("_short"), 0)

    counters = {
        "total_input_samples": F.sum(whole.otherwise(F.col("input_samples"))),
        "total_output_chunks": F.count("chunk_idx"),
        "total_tokens_written": F.sum(F.when(F.col("chunk_idx").isNotNull(), F.col("len"))),
        "total_duplicated_tokens": F.sum("duplicated_tokens"),
        "total_tokens_skipped": F.sum(whole.otherwise(F.col("skipped_tokens"))),
        "total_samples_skipped_by_length": F.sum(F.col("_short").cast("int")),
    }
    return rollup_sums(rows, by, counters)


def written_chunk_stats(
    tokens: DataFrame, chunks: DataFrame, cfg: ChunkConfig, *, by: Sequence[str] = ("subset",)
) -> DataFrame:
    """The same counters from tables on disk, without cutting again or reading an array.

    Chunks tell what was written, duplicated and skipped; the stored lengths of
    the tokenized samples tell how many there were and how many were too short.
    """
    size = sample_size(tokens)
    long = size >= cfg.min_sample_tokens
    lost = F.when(long, size).otherwise(0) if cfg.window <= 0 else F.lit(0)
    inputs = tokens.groupBy(*named(tokens, by)).agg(
        F.count_if(long).alias("total_input_samples"),
        F.lit(0).cast("bigint").alias("total_output_chunks"),
        F.lit(0).cast("bigint").alias("total_tokens_written"),
        F.lit(0).cast("bigint").alias("total_duplicated_tokens"),
        F.sum(lost).cast("bigint").alias("total_tokens_skipped"),
        F.count_if(~long).alias("total_samples_skipped_by_length"),
    )
    outputs = chunks.groupBy(*named(chunks, by)).agg(
        F.lit(0).cast("bigint").alias("total_input_samples"),
        F.count("*").alias("total_output_chunks"),
        F.sum("len").cast("bigint").alias("total_tokens_written"),
        F.sum("duplicated_tokens").cast("bigint").alias("total_duplicated_tokens"),
        F.sum("skipped_tokens").cast("bigint").alias("total_tokens_skipped"),
        F.lit(0).cast("bigint").alias("total_samples_skipped_by_length"),
    )
    both = inputs.unionByName(outputs)
    counters = [c for c in both.columns if c not in by]
    return both.rollup(*by).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counters]
    )


def length_percentiles(
    df: DataFrame, *, by: Sequence[str] = ("subset",), length: str = "len", step: int = 10
) -> DataFrame:
    """p0..p100 per group: the value at rank ``min(int(n*p/100), n-1)`` of the sorted lengths.

    Works on the histogram of lengths, so a window sees one row per distinct
    length and not one per chunk.
    """
    histogram = df.groupBy(*by, length).agg(F.count("*").alias("_n"))
    ordered = Window.partitionBy(*by).orderBy(length)
    total = F.sum("_n").over(Window.partitionBy(*by))
    cumulative = histogram.select(
        *by,
        F.col(length).alias("_len"),
        F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        total.alias("_total"),
    )
    aggs = []
    for p in range(0, 101, step):
        rank = F.least(F.floor(F.col("_total") * p / 100.0), F.col("_total") - 1)
        hit = F.min(F.when(F.col("_cum") > rank, F.col("_len")))
        aggs.append(hit.cast("bigint").alias(f"p{p}"))
    return cumulative.groupBy(*by).agg(*aggs)


def _bare(ids: Column, cfg: ChunkConfig) -> Column:
    """Without a leading BOS and a trailing EOS."""
    lead = F.coalesce((F.get(ids, F.lit(0)) == cfg.bos_id).cast("int"), F.lit(0))
    trail = F.lit(0)
    if cfg.eos_id is not None:
        ends = (F.size(ids) > lead) & (F.get(ids, F.size(ids) - 1) == cfg.eos_id)
        trail = F.coalesce(ends.cast("int"), F.lit(0))
    return F.slice(ids, lead + 1, F.size(ids) - lead - trail)


def _reencoded(
    rows: DataFrame,
    column: str,
    cfg: ChunkConfig,
    reencode: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """Apply the prefix-space step to arrays that do not open with BOS."""
    opens = F.coalesce(F.get(F.col(column), F.lit(0)) == cfg.bos_id, F.lit(False))
    todo = rows.withColumn("_todo", F.when(~opens, F.col(column)))
    done = reencode(todo, "_todo")
    fixed = F.slice("_todo", F.lit(1), F.lit(cfg.window))
    return done.withColumn(column, F.coalesce(fixed, F.col(column))).drop("_todo")
