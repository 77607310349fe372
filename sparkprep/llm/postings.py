"""Benchmark decontamination by a positional inverted index of the training texts.

The index is cut into segments, runs of documents with at most ``SEGMENT_CHARS``
characters (or one longer document). In a segment every word has a place, one after another, with a
gap between documents; the index holds one row per word and segment with the ascending
places of that word. It knows nothing of the benchmark and may be kept and asked again.

A benchmark item is cut into windows of consecutive words. The words of a window are
ordered by how often the corpus has them. Only the segments that hold its rarest word
meet the window. There the places of that word, moved back by its offset in the window,
are the possible starts; they are intersected with the moved lists of the other
words, the next rarest first, until none is left or all words have agreed:

* a phrase match has every word exactly at its offset from the start;
* a proximity match has every word within ``slop`` places of its offset.

The windows one segment meets are dealt over several tasks if there are very many. Nothing is
broadcast by this module and nothing but one count reaches the driver.

Documents: a null text has no words; rows are kept apart, also those that share an id.
Items: a null or wordless text has no window; rows that share an ``item_id`` are one item; an
item without an id marks words but is not listed.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.llm.common import stored

WINDOW = 10
SLOP = 2
SEGMENT_CHARS = 8_000_000
WINDOWS_PER_TASK = 65_536

# A word is a run of these characters' complement, after lower-casing A-Z.
SEPARATORS = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _byte_table() -> bytes:
    """Bytes of words stay, A-Z become a-z, all other ASCII bytes become a space."""
    table = bytearray(range(256))
    for b in range(128):
        c = chr(b).lower()
        table[b] = ord(c) if c.isalnum() else 32
    return bytes(table)


_TABLE = _byte_table()

INDEX_SCHEMA = (
    "segment bigint, term string, n int, places array<int>, doc_ids array<bigint>, counts array<int>"
)


def words_of_item(text: Column) -> Column:
    """The words of a text, in order, in the JVM."""
    return F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(f"[^{SEPARATORS}]+"), F.lit(0))


def tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts one after another, and the number of each text's words."""
    texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = bytes(data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))).translate(_TABLE) if data else b""
    # UTF-8 keeps ASCII bytes to itself, so the texts stay where they are.
    plain = pa.StringArray.from_buffers(
        len(texts), pa.py_buffer((offsets - offsets[0]).astype(np.int32).tobytes()), pa.py_buffer(raw)
    )
    lists = pc.ascii_split_whitespace(plain)
    flat = lists.flatten()
    real = np.asarray(pc.binary_length(flat)) > 0
    row = np.repeat(np.arange(len(texts)), np.diff(np.asarray(lists.offsets)))
    return flat.filter(pa.array(real)), np.bincount(row[real], minlength=len(texts))


def _slices(texts: pa.Array):
    """Parts of a batch with at most ``SEGMENT_CHARS`` characters, or a single row."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + SEGMENT_CHARS, "right")))
        yield start, end
        start = end


def _int_lists(values: np.ndarray, sizes: np.ndarray, kind) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _index(gap: int, batches):
    number = TaskContext.get().partitionId() << 32
    names = ["segment", "term", "n", "places", "doc_ids", "counts"]
    for batch in batches:
        for start, end in _slices(batch.column(1)):
            words, counts = tokens(batch.column(1).slice(start, end - start))
            bases = np.cumsum(counts + gap) - counts
            coded = words.dictionary_encode()
            codes = np.asarray(coded.indices)
            places = np.arange(len(codes)) + np.repeat(bases - (np.cumsum(counts) - counts), counts)
            order = np.argsort(codes, kind="stable")
            n = len(coded.dictionary)
            often = np.bincount(codes, minlength=n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, number)),
                    coded.dictionary,
                    pa.array(often, pa.int32()),
                    _int_lists(places[order].astype(np.int32), often, pa.int32()),
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.nulls(n, pa.list_(pa.int32())),
                ],
                names,
            )
            # One row that tells which documents the segment has, and where they begin.
            ids = batch.column(0).slice(start, end - start)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.array([None], pa.string()),
                    pa.array([end - start], pa.int32()),
                    pa.array([bases.astype(np.int32)], pa.list_(pa.int32())),
                    pa.array([ids.to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
                ],
                names,
            )
            number += 1


def build_index(
    df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", reach: int = WINDOW + 2 * SLOP
) -> DataFrame:
    """The index of a table of texts (``INDEX_SCHEMA``), written to the shared folder.

    Rows without a ``term`` describe a segment's documents. Documents are ``reach`` places
    apart, so that nothing of at most that reach goes from one into the next.
    """
    rows = df.select(F.col(doc_id).cast("bigint"), F.col(text))
    return stored(rows.mapInArrow(functools.partial(_index, reach), INDEX_SCHEMA), "postings")


def windows(items: DataFrame, *, item_id: str = "item_id", text: str = "text", width: int = WINDOW) -> DataFrame:
    """``item, win, terms``: every window of every item; ``win`` names equal windows alike."""
    worded = items.select(F.col(item_id).cast("string").alias("item"), words_of_item(F.col(text)).alias("w"))
    last = F.greatest(F.size("w") - width, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(F.col("w"), i + 1, F.lit(width)))
    each = worded.where(F.size("w") > 0).select("item", F.explode(cut).alias("terms"))
    return each.select("item", F.md5(F.array_join("terms", " ")).alias("win"), "terms").distinct()


def _plans(cut: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``win, plan`` (term and offset, the rarest first), and the postings of their terms.

    Postings are read from the index where they are used; counting them reads no places.
    """
    each = cut.select("win", "terms").dropDuplicates(["win"])
    placed = each.select("win", F.posexplode("terms").alias("offset", "term"))
    asked = placed.select("term").distinct()
    postings = index.where("term is not null").select("segment", "term", "n", "places")
    postings = postings.join(asked, "term", "left_semi")
    seen = postings.groupBy("term").agg(F.sum("n").alias("n"))
    step = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term")
    plans = placed.join(seen, "term", "left").groupBy("win").agg(F.sort_array(F.collect_list(step)).alias("plan"))
    # A word that the corpus does not have comes first.
    return plans.where("plan[0].n > 0").select("win", "plan"), postings


def _agree(starts: np.ndarray, places: np.ndarray, offset: int, slop: int) -> np.ndarray:
    """The starts that have a place within ``slop`` of ``offset`` behind them.

    The few starts are moved, not the list of places; both are of one type, which saves a copy.
    """
    at = np.searchsorted(places, starts + (offset - slop))
    inside = at < len(places)
    kept = starts[inside]
    return kept[places[at[inside]] <= kept + (offset + slop)]


def _match(slop: int, postings: pa.Table, asked: pa.Table) -> pa.Table:
    """Matches of the windows in one segment, one row per document that has any."""
    head = pc.is_null(postings.column("term"))
    lists = postings.column("places").combine_chunks()
    flat, ends = np.asarray(lists.values), np.asarray(lists.offsets)
    terms = postings.column("term").to_pylist()
    bases = np.zeros(0, np.int32)
    at: dict[str, np.ndarray] = {}
    for i, (term, first) in enumerate(zip(terms, head.to_pylist())):
        if first:
            bases = flat[ends[i] : ends[i + 1]]
        else:
            at[term] = flat[ends[i] : ends[i + 1]]
    exact: dict[int, tuple[list, list]] = {}
    near: dict[int, list] = {}
    none = np.zeros(0, np.int32)
    steps = np.arange(-slop, slop + 1, dtype=np.int32)
    for win, plan in zip(asked.column("win").to_pylist(), asked.column("plan").to_pylist()):
        lists_of = [(at.get(p["term"], none), p["offset"]) for p in plan]
        if not all(len(x) for x, _ in lists_of):
            continue
        first = lists_of[0][0] - lists_of[0][1]
        loose = np.unique((first[:, None] + steps).ravel())
        for places, offset in lists_of[1:]:
            loose = _agree(loose, places, offset, slop)
            if not len(loose):
                break
        if not len(loose):
            continue  # a phrase is a proximity match too
        for doc in np.unique(np.searchsorted(bases, loose + slop, "right") - 1).tolist():
            near.setdefault(doc, []).append(win)
        starts = loose
        for places, offset in lists_of:
            starts = _agree(starts, places, offset, 0)
        docs = np.searchsorted(bases, starts, "right") - 1
        for doc in np.unique(docs).tolist():
            own = starts[docs == doc] - bases[doc]
            wins, hits = exact.setdefault(doc, ([], []))
            wins.append(win)
            hits.append((own[:, None] + np.arange(len(plan))).ravel())
    rows = sorted(near)
    hits = [np.unique(np.concatenate(exact[r][1])) if r in exact else [] for r in rows]
    segment = postings.column("segment")[0].as_py() if len(postings) else 0
    return pa.table(
        [
            pa.array([segment] * len(rows), pa.int64()),
            pa.array(rows, pa.int32()),
            pa.array([exact[r][0] if r in exact else [] for r in rows], pa.list_(pa.string())),
            pa.array([near[r] for r in rows], pa.list_(pa.string())),
            pa.array(hits, pa.list_(pa.int32())),
        ],
        names=["segment", "row", "exact", "near", "hits"],
    )


def matches(index: DataFrame, cut: DataFrame, slop: int = SLOP) -> DataFrame:
    """``segment, row, exact, near, hits`` of the documents that have a match.

    ``exact`` and ``near`` are the windows that occur as a phrase or by proximity, ``hits`` the
    numbers of the document's words that lie in a phrase match.
    """
    plans, postings = _plans(cut, index)
    plans = stored(plans, "plans")
    parts = max(1, -(-plans.count() // WINDOWS_PER_TASK))
    part = F.pmod(F.xxhash64("win"), F.lit(parts)).cast("int").alias("part")
    first = plans.select("win", F.col("plan.offset").alias("offset"), F.col("plan.term").alias("name"), part)
    asked = (
        postings.select("segment", "term")
        .join(first.withColumn("term", F.get("name", F.lit(0))), "term")
        .select("segment", "part", "win", F.arrays_zip(F.col("name").alias("term"), "offset").alias("plan"))
    )
    live = asked.select("segment").distinct()
    heads = index.where("term is null").select("segment", "term", "places").join(live, "segment", "left_semi")
    given = postings.join(live, "segment", "left_semi").select("segment", "term", "places").union(heads)
    spread = given.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # New names: both sides come from the postings, and Spark must tell their columns apart.
    left, right = (df.toDF(*df.columns).groupBy("segment", "part") for df in (spread, asked))
    found = (
        left.cogroup(right)
        .applyInArrow(
            lambda left, right: _match(slop, left, right),
            "segment bigint, row int, exact array<string>, near array<string>, hits array<int>",
        )
    )
    merged = {c: F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("exact", "near", "hits")}
    return found.groupBy("segment", "row").agg(*merged.values())


def _items(found: DataFrame, cut: DataFrame, column: str) -> DataFrame:
    """``key, items``: for every different list of windows, the items they are from, as strings.

    Documents with the same passages have the same list, so each list is looked up once.
    """
    lists = found.select(_key(column).alias("key"), F.col(column).alias("wins")).dropDuplicates(["key"])
    owners = cut.where(F.col("item").isNotNull()).select("win", "item")
    named = lists.select("key", F.explode("wins").alias("win")).join(owners, "win")
    return named.groupBy("key").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _key(column: str) -> Column:
    return F.md5(F.array_join(column, " "))


def decontaminate(
    docs: DataFrame, items: DataFrame, *, width: int = WINDOW, slop: int = SLOP,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, hits, items, near_items``: one row per document.

    ``items`` are those with a phrase match, ``near_items`` those with a proximity match,
    which includes the former; both sorted as strings.
    """
    index = build_index(docs, doc_id=doc_id, text=text, reach=width + 2 * slop)
    cut = stored(windows(items, item_id=item_id, text=item_text, width=width), "windows")
    found = stored(matches(index, cut, slop), "matches")
    listed = found.select("segment", "row", "hits", _key("exact").alias("_e"), _key("near").alias("_n"))
    for column, key, name in (("exact", "_e", "items"), ("near", "_n", "near_items")):
        names = _items(found, cut, column).select(F.col("key").alias(key), F.col("items").alias(name))
        listed = listed.join(names, key, "left")
    rows = index.where("term is null").select(
        "segment", F.posexplode(F.arrays_zip("doc_ids", "counts")).alias("row", "d")
    )
    done = rows.join(listed, ["segment", "row"], "left")
    nothing = F.array().cast("array<string>")
    return done.select(
        F.col("d.doc_ids").alias("doc_id"),
        F.col("d.counts").cast("bigint").alias("n_words"),
        F.coalesce("hits", F.array().cast("array<int>")).alias("hits"),
        F.coalesce("items", nothing).alias("items"),
        F.coalesce("near_items", nothing).alias("near_items"),
    )
