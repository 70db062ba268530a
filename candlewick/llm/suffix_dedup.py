"""Suffix-array dedup: remove every byte covered by a ``WINDOW``-byte string that starts
anywhere else too.

1. Every window is represented by its anchor (``anchors.py``), a window-long text by about three
   rows: the anchor's gram hash, the range of windows it stands for and a digest of the bytes
   they cover (its context).
2. Anchors whose gram is unique are done. Where all contexts of a gram are equal, all their
   windows are repeated. Only the other grams need their bytes: one representative for each
   distinct context is cut from the texts.
3. The suffixes from the anchors of one gram, and the reversed prefixes before them, are sorted
   deep-shallow. A window with d bytes left of the anchor is repeated if another one has the
   same neighbourhood in both orders: common prefixes of WINDOW - d and d bytes.
4. Grams with more than ``GROUP`` distinct contexts (a passage that a third of all documents
   share) never meet in one task: their windows are split by d into narrower ranges, whose keys
   hold more of the window's bytes, down to single windows, whose key is the whole window.

Sorting needs text bytes only for ambiguous grams, so what is shuffled stays near the input's
size. Null and short texts lose nothing. Repeated rows count as different places and lose
everything from ``WINDOW`` bytes on. Ids may be null or tied; texts are read whole; columns other
than id and text are not carried. An empty table gives an empty result. Equality of grams and
contexts is decided by 64-bit hashes of each (128 bits together for equal contexts).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, IntegerType, LongType, StructField,
                               StructType)

from candlewick.llm import common as C
from candlewick.llm.anchors import GRAM, WINDOW, anchors, digest
from candlewick.llm.suffix_sort import deep_shallow, neighbours

SHALLOW = GRAM + 32
GROUP = 256
#: Widths in d of the ranges that large groups are split into, one level after the other.
WIDTHS = (40, 8, 1)
KEYS = ["key_a", "key_b"]


def _fields(spec: str) -> StructType:
    kinds = {"l": LongType(), "i": IntegerType(), "b": BinaryType()}
    return StructType([StructField(n, kinds[k]) for n, k in (x.split(":") for x in spec.split())])


PLACE = "key_a:l key_b:l anchor:i first:i last:i key:l ctx:l"


def anchor_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for every anchor: its row's key, places in the text, gram hash and context digest."""
    schema = _fields(PLACE)

    def run(batches):
        for batch in batches:
            for part in C.slices(batch, 0):
                texts = C.texts_of(part, 0)
                text, anchor, first, last, gram = anchors(texts)
                ctx = [digest(texts[t][a:b + WINDOW]) for t, a, b in
                       zip(text.tolist(), first.tolist(), last.tolist())]
                take = pa.array(text, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).take(take), part.column(2).take(take),
                     *[pa.array(x, pa.int32()) for x in (anchor, first, last)],
                     pa.array(gram.view(np.int64)), pa.array(ctx, pa.int64())], names=schema.names)

    return docs.select(text_col, *C.row_keys(id_col, text_col)).mapInArrow(run, schema)


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row keys, id and compressed text: what the two joins with the texts shuffle."""
    base = docs.select(F.col(text_col).alias("text"), *C.row_keys(id_col, text_col),
                       F.col(id_col).alias("id"))
    schema = StructType([*base.schema.fields[1:], StructField("packed", BinaryType())])

    def run(batches):
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            for part in C.slices(batch, 0):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(list(map(squeeze, C.texts_of(part, 0))), pa.binary())],
                    names=schema.names)

    return base.mapInArrow(run, schema)


def unpack(column: pa.Array) -> list[bytes]:
    expand = zstandard.ZstdDecompressor().decompress
    return [expand(x) for x in column.to_pylist()]


CONTEXT = "key:l ctx:l n:l pos:i own:i data:b"


def cut_contexts(batches):
    """Bytes of the representative contexts of each text."""
    for batch in batches:
        rows = []
        for data, places in zip(unpack(batch.column(0)), batch.column(1).to_pylist()):
            rows += [(p["key"], p["ctx"], p["n"], p["anchor"] - p["first"], p["last"] - p["first"],
                      data[p["first"]:p["last"] + WINDOW]) for p in places]
        yield _batch(rows, CONTEXT)


def _batch(rows: list[tuple], spec: str) -> pa.RecordBatch:
    kinds = {"l": pa.int64(), "i": pa.int32(), "b": pa.binary()}
    named = [x.split(":") for x in spec.split()]
    columns = list(zip(*rows)) or [()] * len(named)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)],
                                      names=[n for n, _ in named])


def classes(common: np.ndarray, order: list[int], least: np.ndarray) -> np.ndarray:
    """For each bound of ``least``, the class of every suffix: neighbours in order that share at
    least so many bytes are in one class."""
    number = np.cumsum(common[None, :] < least[:, None], axis=1)
    out = np.empty_like(number)
    out[:, order] = number
    return out


def repeated_windows(group: list[dict]) -> list[tuple[int, int, int]]:
    """(member, first, last window) of the ranges of windows that stand in another context of
    the group too, or in all copies of their own."""
    right = [g["data"][g["pos"]:] for g in group]
    left = [g["data"][:g["pos"]][::-1] for g in group]
    same = all(r[:GRAM] == right[0][:GRAM] for r in right)
    orders = [deep_shallow(right, GRAM if same else 0, SHALLOW), deep_shallow(left, 0, 32)]
    common = [np.array(neighbours(s, o)) for s, o in zip((right, left), orders)]
    pos, own = (np.array([g[x] for g in group]) for x in ("pos", "own"))
    d = np.arange(max(0, int((pos - own).min())), int(pos.max()) + 1)
    code = (classes(common[0], orders[0], WINDOW - d) * (len(group) + 1)
            + classes(common[1], orders[1], d))
    has = (d[:, None] <= pos) & (d[:, None] >= pos - own)
    code = np.where(has, code, -1 - np.arange(len(group)))        # no window: alone
    by = np.argsort(code, axis=1, kind="stable")
    ranked = np.take_along_axis(code, by, axis=1)
    twin = np.zeros(ranked.shape, bool)
    equal = ranked[:, 1:] == ranked[:, :-1]
    twin[:, 1:] |= equal
    twin[:, :-1] |= equal
    hit = np.empty_like(twin)
    np.put_along_axis(hit, by, twin, axis=1)
    out = []
    for k, g in enumerate(group):
        if g["n"] > 1:
            out.append((k, 0, int(own[k])))
            continue
        at = pos[k] - d[hit[:, k]][::-1]                          # ascending window starts
        if len(at):
            cuts = np.flatnonzero(np.diff(at) > 1)
            out += [(k, a, b) for a, b in zip(at[np.r_[0, cuts + 1]].tolist(),
                                              at[np.r_[cuts, len(at) - 1]].tolist())]
    return out


RANGE = "key:l ctx:l lo:i hi:i"


def sort_groups(batches):
    for batch in batches:
        rows = []
        for key, members in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            group = list({m["ctx"]: m for m in members}.values())
            rows += [(key, group[k]["ctx"], a, b) for k, a, b in repeated_windows(group)]
        yield _batch(rows, RANGE)


PART = "key:l ctx:l at:i sub_key:l sub_ctx:l pos:i own:i data:b"


def split_ranges(width: int):
    """Cut contexts into ranges of d that are aligned to ``width``. All windows of a range hold
    the bytes between its outermost windows; these make the new key."""
    def run(batches):
        for batch in batches:
            rows = []
            for c in batch.to_pylist():
                pos, data = c["pos"], c["data"]
                for s in range((pos - c["own"]) // width, pos // width + 1):
                    x, y = s * width, s * width + width - 1
                    low, high = max(x, pos - c["own"]), min(y, pos)       # the context's own d
                    cover = data[pos - high:pos - low + WINDOW]
                    key = xxhash.xxh3_64_intdigest(data[pos - x:pos - y + WINDOW], seed=s) - (1 << 63)
                    ctx = xxhash.xxh3_64_intdigest(cover, seed=high) - (1 << 63)
                    rows.append((c["key"], c["ctx"], pos - high, key, ctx, high, high - low, cover))
            yield _batch(rows, PART)
    return run


def resolve(contexts: DataFrame, widths: tuple[int, ...] = WIDTHS, group: int = GROUP) -> DataFrame:
    """``key, ctx, lo, hi``: repeated windows, from the context's first, of distinct contexts
    (``CONTEXT``) whose keys have two or more of them."""
    hot = C.shared_table(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
                         .where(F.col("m") > group).select("key"), "large-groups")
    some = hot.count() > 0
    small = contexts.join(hot, "key", "left_anti") if some else contexts
    members = F.collect_list(F.struct("ctx", "n", "pos", "own", "data")).alias("members")
    found = small.groupBy("key").agg(members).mapInArrow(sort_groups, _fields(RANGE))
    if not some:
        return found
    large = C.shared_table(contexts.join(hot, "key", "left_semi"), "large-contexts")
    whole = (large.where("n > 1").select("key", "ctx", F.lit(0).alias("lo"), F.col("own").alias("hi")))
    parts = C.shared_table(large.mapInArrow(split_ranges(widths[0]), _fields(PART)), "parts")
    sub = C.shared_table(
        parts.groupBy("sub_key", "sub_ctx").agg(
            F.count(F.lit(1)).alias("n"), F.first("pos").alias("pos"), F.first("own").alias("own"),
            F.first("data").alias("data")).withColumnsRenamed({"sub_key": "key", "sub_ctx": "ctx"}),
        "sub-contexts")
    done = sub.where("n > 1").select("key", "ctx", F.lit(0).alias("lo"), F.col("own").alias("hi"))
    if widths[1:]:
        many = C.shared_table(sub.groupBy("key").agg(F.count(F.lit(1)).alias("m"))
                              .where("m > 1").select("key"), "sub-keys")
        done = done.unionByName(resolve(C.shared_table(sub.join(many, "key"), "sub-groups"),
                                        widths[1:], group))
    done = C.shared_table(done.withColumnsRenamed({"key": "sub_key", "ctx": "sub_ctx"}), "sub-ranges")
    back = (parts.select("key", "ctx", "at", "sub_key", "sub_ctx").join(done, ["sub_key", "sub_ctx"])
            .select("key", "ctx", (F.col("at") + F.col("lo")).alias("lo"),
                    (F.col("at") + F.col("hi")).alias("hi")))
    return found.unionByName(whole).unionByName(back)


def merged(ranges: DataFrame) -> DataFrame:
    """One row for each context: its ranges of windows, neighbouring ones joined into one."""
    kind = "array<struct<lo:int,hi:int>>"

    def add(acc: F.Column, r: F.Column) -> F.Column:
        last = F.element_at(acc, -1)
        longer = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], r["hi"]).alias("hi"))
        return (F.when(F.size(acc) == 0, F.array(r)).when(r["lo"] > last["hi"] + 1, F.concat(acc, F.array(r)))
                .otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer)))).cast(kind)

    found = F.array_sort(F.collect_list(F.struct("lo", "hi")))
    rows = ranges.groupBy("key", "ctx").agg(found.alias("found"))
    return rows.select("key", "ctx", F.aggregate("found", F.array().cast(kind), add).alias("windows"))


def repeated_spans(docs: DataFrame, texts: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Row keys and ``ranges``: byte ranges (start, end) that repeated windows cover."""
    rows = C.shared_table(anchor_rows(docs, id_col, text_col), "anchors")
    grams = C.shared_table(
        rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("a"), F.max("ctx").alias("b"))
        .where("n > 1").select("key", (F.col("a") != F.col("b")).alias("mixed"), "n"), "grams")
    near = C.shared_table(C.join_counted(rows, grams, ["key"], "n").drop("n"), "repeated-grams")
    mixed = near.where("mixed")
    places = (mixed.groupBy("key", "ctx")
              .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*KEYS, "anchor", "first", "last")).alias("p"))
              .select("p.*", F.struct("key", "ctx", "n", "p.anchor", "p.first", "p.last").alias("place"))
              .groupBy(*KEYS).agg(F.collect_list("place").alias("places")))
    contexts = C.shared_table(
        texts.join(places, KEYS).select("packed", "places").mapInArrow(cut_contexts, _fields(CONTEXT))
        .dropDuplicates(["key", "ctx"]), "contexts")
    ranges = C.shared_table(merged(resolve(contexts)).join(contexts.select("key", "ctx", "n"), ["key", "ctx"]),
                            "ranges")
    some = C.join_counted(mixed, ranges, ["key", "ctx"], "n").select(*KEYS, F.transform("windows", lambda w: F.struct(
        (F.col("first") + w["lo"]).alias("start"), (F.col("first") + w["hi"] + WINDOW).alias("end"))).alias("r"))
    every = near.where("not mixed").select(*KEYS, F.array(F.struct(
        F.col("first").alias("start"), (F.col("last") + WINDOW).alias("end"))).alias("r"))
    return (some.unionByName(every).groupBy(*KEYS)
            .agg(F.flatten(F.collect_list("r")).alias("ranges")))


def union(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of the covered bytes."""
    out: list[list[int]] = []
    for a, b in sorted((r["start"], r["end"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``spans`` (removed byte runs) and ``kept``, the remaining bytes."""
    texts = packed(docs, id_col, text_col)
    spans = C.shared_table(repeated_spans(docs, texts, id_col, text_col), "spans")
    joined = texts.join(spans, KEYS, "left").select("id", "packed", "ranges")
    schema = StructType([StructField(id_col, joined.schema["id"].dataType), StructField("n_bytes", LongType()),
                         StructField("spans", ArrayType(SPAN)), StructField("kept", BinaryType())])
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = unpack(batch.column(1))
            spans = [union(r or []) for r in batch.column(2).to_pylist()]
            kept = [b"".join(t[a:b] for a, b in zip([0, *(e for _, e in s)], [*(x for x, _ in s), len(t)]))
                    for t, s in zip(texts, spans)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(map(len, texts)), pa.int64()),
                 pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], kind),
                 pa.array(kept, pa.binary())], names=schema.names)

    return joined.mapInArrow(run, schema)
