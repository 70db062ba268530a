"""SimHash near-dedup with a segment-popcount embedding.

A fingerprint is mapped to the bit counts of its 32 two-bit segments. Counts are written in
unary (0: 00, 1: 01, 2: 11), so the Manhattan distance of two embeddings is the number of bits
that differ between the unary words, and it never exceeds the Hamming distance.

Grid range-join: within Manhattan distance d at most d of the grid's axes differ, so of ``groups``
groups of axes at least ``groups - d`` are equal, and the points meet in the grid cell of some
choice of ``groups - d`` groups. Only distinct fingerprints enter cells. In a cell, candidates
must pass the Manhattan bound and then the exact bit distance; what leaves the cell is a spanning
forest of its links, not its pairs. Cells with more than ``CELL`` members are dealt anew on finer
grids, the last of which (one-bit segments, 13 of 16 groups equal) can't hold more than 4,096
members; no link is lost on the way.

Null and empty texts have fingerprint 0 and link like any other. Repeated rows share their
fingerprint. Null ids can't be the smallest of a component unless all are null. Very long texts
are read whole. An empty table gives an empty result. Columns other than the id are not carried.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from candlewick.llm import common as C
from candlewick.llm.components import components

SHINGLE, SEED, MOST_BITS = 3, 42, 3
CELL = 4096
#: (bits of a segment, groups of axes) of the grids, from coarse to fine.
GRIDS = ((2, 6), (1, 8), (1, 16))
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
EVEN = 0x5555555555555555


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    last = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in
                     zip(starts[:last].tolist(), (ends[min(shingle, len(words)) - 1:] - 1).tolist())),
                    np.uint64, last)
    ones = np.zeros(64, np.int64)
    for k in range(0, last, 4096):
        bits = np.unpackbits(h[k:k + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, text_col: str = "text") -> DataFrame:
    """Append ``fp``, the fingerprint as a signed long."""
    def run(texts):
        fps = np.array([simhash(t, shingle) for t in texts], np.uint64)
        return [pa.array(fps.view(np.int64))]

    return C.with_text_columns(docs, text_col, [StructField("fp", LongType())], lambda: run)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def embedding(fp: Column, segment: int) -> Column:
    """Unary bit counts of the segments; one-bit segments are their own counts."""
    if segment == 1:
        return fp
    half = F.shiftrightunsigned(fp, 1)
    even = F.lit(EVEN)
    return (fp.bitwiseOR(half).bitwiseAND(even)).bitwiseOR(
        F.shiftleft(fp.bitwiseAND(half).bitwiseAND(even), 1))


def grid_masks(segment: int, groups: int, bits: int) -> list[int]:
    """Masks of the axes of every choice of ``groups - bits`` groups."""
    axes = 64 // segment
    group = [sum(((1 << segment) - 1) << segment * k for k in range(axes) if k * groups // axes == g)
             for g in range(groups)]
    return [_signed(sum(c)) for c in combinations(group, groups - bits)]


def unary(fps: np.ndarray) -> np.ndarray:
    even, one = np.uint64(EVEN), np.uint64(1)
    return ((fps | fps >> one) & even) | ((fps & fps >> one & even) << one)


def forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among a cell's fingerprints (breadth first)."""
    edges, left = [], fps
    counts = unary(fps)
    while len(left) > 1:
        todo = [(left[0], counts[0])]
        left, counts = left[1:], counts[1:]
        while todo and len(left):
            x, c = todo.pop()
            near = np.flatnonzero(np.bitwise_count(counts ^ c) <= bits)      # lower bound
            near = near[np.bitwise_count(left[near] ^ x) <= bits]            # exact
            if len(near):
                edges += [(x, y) for y in left[near]]
                todo += list(zip(left[near], counts[near]))
                rest = np.ones(len(left), bool)
                rest[near] = False
                left, counts = left[rest], counts[rest]
    return edges


EDGE = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _cell_edges(bits: int):
    def run(batches):
        for batch in batches:
            column = batch.column(0)
            sizes = column.value_lengths().to_numpy()
            flat = column.flatten().to_numpy().view(np.uint64)
            starts = np.cumsum(sizes) - sizes
            two = starts[sizes == 2]
            x, y = flat[two], flat[two + 1]
            ok = np.bitwise_count(unary(x) ^ unary(y)) <= bits
            ok[ok] = np.bitwise_count(x[ok] ^ y[ok]) <= bits
            a, b = [x[ok]], [y[ok]]
            more = [e for s, n in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist())
                    for e in forest(flat[s:s + n], bits)]
            if more:
                pairs = np.array(more, np.uint64)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], names=["a", "b"])
    return run


def links(fps: DataFrame, bits: int = MOST_BITS) -> DataFrame:
    """Edges (a, b) whose components are those of all links at ``bits`` or fewer differing bits
    among the distinct fingerprints of ``fps`` (column fp)."""
    out, level = None, fps.select("fp")
    for k, (segment, groups) in enumerate(GRIDS):
        masks = grid_masks(segment, groups, bits)
        e = embedding(F.col("fp"), segment)
        cells = level.select("fp", F.explode(F.array(*[
            F.struct(F.lit(i).cast("short").alias("grid"), e.bitwiseAND(F.lit(m)).alias("cell"))
            for i, m in enumerate(masks)])).alias("x")).select("x.grid", "x.cell", "fp")
        last = k == len(GRIDS) - 1
        if not last:
            hot = C.shared_table(cells.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n"))
                                 .where(F.col("n") > CELL).select("grid", "cell"), "hot-cells")
            some = hot.count() > 0
            if some:
                level = C.shared_table(cells.join(hot, ["grid", "cell"]).select("fp").distinct(), "hot-fps")
                cells = cells.join(hot, ["grid", "cell"], "left_anti")
        found = (cells.groupBy("grid", "cell").agg(F.collect_list("fp").alias("fps"))
                 .where(F.size("fps") > 1).select(F.array_sort("fps").alias("fps"))
                 .mapInArrow(_cell_edges(bits), EDGE).distinct())
        out = found if out is None else out.unionByName(found)
        if last or not some:
            return out


def near_classes(docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS,
                 id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows (id, row keys, fp) and classes (fp, ``group_fp``, ``component_id``, ``n_rows`` with this
    fp): fingerprints that links connect share ``group_fp``, the least of them as a signed number."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                       *C.row_keys(id_col, text_col))
    rows = C.shared_table(fingerprints(slim, shingle).drop("text"), "fingerprints")
    fps = C.shared_table(rows.groupBy("fp").agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("n_rows")),
                         "distinct-fps")
    roots = C.shared_table(components(links(fps, bits)), "roots")
    member = C.shared_table(fps.join(roots, fps["fp"] == roots["node"]).select("fp", "root", "least_id", "n_rows"), "members")
    least = C.shared_table(member.groupBy("root").agg(F.min("least_id").alias("component_id"),
                                                      F.count(F.lit(1)).alias("n_fps")), "least-ids")
    linked = C.join_counted(member, least, ["root"], "n_fps").select(
        "fp", F.col("root").alias("group_fp"), "component_id", "n_rows")
    alone = fps.join(member, "fp", "left_anti").select(
        "fp", F.col("fp").alias("group_fp"), F.col("least_id").alias("component_id"), "n_rows")
    return rows, C.shared_table(linked.unionByName(alone), "classes")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``fp`` and ``component_id``, the smallest id that is reachable by links."""
    rows, classes = near_classes(docs, shingle, bits, id_col, text_col)
    return (C.join_counted(rows, classes, ["fp"], "n_rows")
            .select(F.col("id").alias(id_col), "fp", "component_id"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, bits: int = MOST_BITS,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the smallest id
    stays (null ids last; of rows with equal id and text, any one)."""
    rows, classes = near_classes(docs, shingle, bits, id_col, text_col)
    order = F.struct(F.isnull("id").alias("no_id"), "id", "key_a", "key_b")
    # copies of one fingerprint are narrowed to one row before they meet their class
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    stay = C.shared_table(first.join(classes, "fp").groupBy("group_fp").agg(F.min("first").alias("first"))
                          .select("first.key_a", "first.key_b"), "representatives")
    base = C.without(docs, ["key_a", "key_b"])
    keys = C.row_keys(id_col, text_col)
    return (base.withColumns({"key_a": keys[0], "key_b": keys[1]}).join(stay, ["key_a", "key_b"], "left_semi")
            .dropDuplicates(["key_a", "key_b"]).select(*[F.col(f"`{c}`") for c in base.columns]))
