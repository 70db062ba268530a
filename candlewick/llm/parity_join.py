"""N-gram Jaccard join by parity sketches.

A document is its set of distinct word n-grams, hashed to 64 bits; two sets link at a Jaccard
likeness of ``num / den`` or more, which says that their symmetric difference is at most
(den - num) / (den + num) of the sum of their sizes.

1. XOR-hashing each n-gram into a bit of a sketch makes every bit a parity, and each n-gram of the
   difference flips one bit: the Hamming distance of two sketches is at most the difference.
2. Sizes fall into bands. A band allows ``d`` differences, so its sketches have d + 1 segments of 64
   bits; by the pigeonhole principle two linked sets agree in one segment at least. A set enters its
   own band and those whose sizes it can still link with, with a cell for each segment.
3. Cells of equal segments are found by one sort; sets that meet are candidates. The distance of
   parity sketches of the whole sets splits a cell into groups that no link can leave.
4. In each group the least set is the pivot, and the exact difference of every other set to the pivot
   is taken once. The difference of two sets is the difference of their differences, so a group
   verifies its pairs on these short lists: first by sketches again, then exactly.
5. A group gives a spanning forest of its links, not its pairs; components follow by star contraction.

Equal sets are one set throughout. Cells with more members than ``CELL`` (fewer for long texts) are
cut into chunks; members that the pivot does not link meet every chunk, so no pair is lost and no
task holds a whole cell. Lines of a long run are streamed, never collected.

Null texts and texts without words have an empty set, which links with nothing, also not with its
like. Texts with fewer words than an n-gram are one n-gram. Null ids can't be the least of a component
unless all are null. Repeated rows have the same set. Very long texts are taken whole. An empty table
gives an empty result. Columns other than the id are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, IntegerType, LongType, StructField,
                               StructType)

from candlewick.llm import common as C
from candlewick.llm.components import components

WORDS, NUM, DEN = 3, 90, 100
#: Members of a cell that one task verifies, and n-grams of them all, at most.
CELL, CELL_GRAMS = 1024, 2_000_000
#: Members that share one copy of their pivot's set.
STAR_MEMBERS = 256
#: A band's largest size against its smallest.
BAND = 1.2
#: Words whose hashes a task remembers.
CACHE = 1 << 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


class WordHashes(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def gram_hashes(text: bytes, words: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams."""
    parts = text.translate(LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, parts), np.uint64, len(parts))
    size = min(words, len(parts))
    n = len(parts) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = C.splitmix(out + h[k:k + n])
    return np.unique(out)


def band_edges(most: int) -> list[int]:
    """Smallest sizes of the bands, up to one above ``most``."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(max(edges[-1] + 1, int(edges[-1] * BAND)))
    return edges


class Bands:
    """Segments of the sketches of every band."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.edges = num, den, band_edges(1 << 12)

    def of(self, n: int) -> Iterator[tuple[int, int]]:
        """(band, segments) that a set of n enters; none where it can only link with its like."""
        if self.edges[-1] <= n * self.den // self.num + 1:
            self.edges = band_edges(2 * (n * self.den // self.num + 1))
        own = int(np.searchsorted(self.edges, n, side="right")) - 1
        if (n + n * self.den // self.num) * (self.den - self.num) < self.den + self.num:
            return
        band = own
        while band == own or self.edges[band] * self.num <= n * self.den:
            largest = self.edges[band + 1] - 1
            yield band, 2 * largest * (self.den - self.num) // (self.den + self.num) + 1
            band += 1

    def cells(self, grams: np.ndarray) -> np.ndarray:
        """One cell a band and segment: a hash of both and of the segment's 64 parities."""
        out = [np.empty(0, np.uint64)]
        for band, segments in self.of(len(grams)):
            at = ((grams >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)).astype(np.int64)
            word = np.zeros(segments, np.uint64)
            np.bitwise_xor.at(word, at, np.uint64(1) << (grams & np.uint64(63)))
            place = np.uint64(band << 40) + np.arange(segments, dtype=np.uint64)
            out.append(C.splitmix(C.splitmix(place) ^ word))
        return np.concatenate(out)


def sketch_bits(n: int, num: int, den: int) -> int:
    """Bits of the parity sketch of a whole set: four to eight times the differences it may have."""
    return 1 << max(9, (8 * n * (den - num) // (den + num)).bit_length())


def sketches(sets: list[np.ndarray], bits: int) -> np.ndarray:
    """Parity sketches of sets, one row of 64-bit words each."""
    sizes = [len(d) for d in sets]
    row = np.repeat(np.arange(len(sets)), sizes)
    bit = (np.concatenate([*sets, np.empty(0, np.uint64)]) >> np.uint64(20) & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(row * bits + bit, minlength=len(sets) * bits) & 1
    return np.packbits(odd.astype(np.uint8).reshape(-1, bits), axis=1).view(np.uint64)


def folded(sketch: bytes, words: int) -> np.ndarray:
    """The sketch of the same set with fewer bits."""
    out = np.frombuffer(sketch, np.uint64)
    while len(out) > words:
        out = out[:len(out) // 2] ^ out[len(out) // 2:]
    return out


def gram_rows(docs: DataFrame, words: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """One row a document: ``id``, row keys, ``node`` (its number), ``n``, a 128-bit digest of the
    set, its ``cells`` and the parity ``sketch`` of the whole set."""
    fields = [StructField("n", LongType()), StructField("set_a", LongType()), StructField("set_b", LongType()),
              StructField("cells", ArrayType(LongType())), StructField("sketch", BinaryType())]

    def make():
        cache, bands = WordHashes(), Bands(num, den)

        def run(texts):
            n, a, b, cells, sketch = [], [], [], [], []
            for text in texts:
                grams = gram_hashes(text, words, cache)
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                n.append(len(grams))
                a.append(int.from_bytes(digest[:8], "big", signed=True))
                b.append(int.from_bytes(digest[8:], "big", signed=True))
                cells.append(bands.cells(grams).view(np.int64))
                sketch.append(sketches([grams], sketch_bits(len(grams), num, den)).tobytes())
            return [pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                    C.list_array(cells, pa.int64()), pa.array(sketch, pa.binary())]
        return run

    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), *C.row_keys(id_col, text_col))
    return (C.with_text_columns(slim, "text", fields, make).drop("text")
            .withColumn("node", F.monotonically_increasing_id()))


MET = StructType([StructField("cell", LongType()), StructField("chunk", IntegerType()),
                  StructField("many", BooleanType()), StructField("pivot", LongType()),
                  StructField("members", ArrayType(LongType()))])


class Runs:
    """Cuts the sorted rows (cell, node, n) of a task into MET rows; a run longer than a chunk leaves
    chunk by chunk."""

    def __init__(self, most: int):
        self.rows: list[tuple] = []
        self.cell, self.pivot, self.chunk = None, None, 0
        self.nodes, self.size, self.most = np.empty(0, np.int64), most, most

    def add(self, cell: int, nodes: np.ndarray, n: int) -> None:
        if cell != self.cell:
            self.close()
            self.cell, self.pivot = cell, int(nodes[0])
            self.size = min(self.most, max(16, CELL_GRAMS // max(n, 1)))
        self.nodes = np.concatenate([self.nodes, nodes])
        while len(self.nodes) > self.size:
            self._leave(self.nodes[:self.size], True)
            self.nodes = self.nodes[self.size:]

    def _leave(self, nodes: np.ndarray, many: bool) -> None:
        self.rows.append((self.cell, self.chunk, many, self.pivot, nodes))
        self.chunk += 1

    def close(self) -> None:
        if len(self.nodes) > 1 or self.chunk:
            self._leave(self.nodes, self.chunk > 0)
        self.cell, self.chunk, self.nodes = None, 0, np.empty(0, np.int64)

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.int32(), pa.bool_(), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, k) for c, k in zip(columns, kinds)), C.list_array(list(columns[4]), pa.int64())],
            names=MET.names)


def _meet(most: int):
    def run(batches):
        runs = Runs(most)
        for batch in batches:
            cell, node, n = (batch.column(k).to_numpy() for k in range(3))
            if not len(cell):
                continue
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(cell)) + 1, [len(cell)]])
            long = np.flatnonzero(np.diff(cuts) > 1)
            # runs of one row are skipped, but for those that may go on in a neighbouring batch
            for k in sorted({0, len(cuts) - 2, *long.tolist()}):
                lo, hi = int(cuts[k]), int(cuts[k + 1])
                runs.add(int(cell[lo]), node[lo:hi], int(n[lo]))
            yield runs.taken()
        runs.close()
        yield runs.taken()
    return run


def linked(n: np.ndarray, other: np.ndarray | int, difference: np.ndarray, num: int, den: int) -> np.ndarray:
    """Sizes and symmetric differences that reach the likeness."""
    both = n + other
    return den * (both - difference) >= num * (both + difference)


GROUP = StructType([StructField("pivot", LongType()), StructField("members", ArrayType(LongType()))])


def groups(n: np.ndarray, sketch: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """Positions of sets that the sketches' lower bound holds together, two or more a group."""
    out, left = [], np.arange(len(n))
    while len(left) > 1:
        group, todo, left = [left[:1]], [int(left[0])], left[1:]
        while todo and len(left):
            x = todo.pop()
            bound = np.bitwise_count(sketch[left] ^ sketch[x]).sum(axis=1, dtype=np.int64)
            near = linked(n[left], n[x], bound, num, den)
            group.append(left[near])
            todo += left[near].tolist()
            left = left[~near]
        if len(found := np.sort(np.concatenate(group))) > 1:
            out.append(found)
    return out


def _groups(num: int, den: int):
    def run(batches):
        for batch in batches:
            found = []
            for k in range(batch.num_rows):
                node, n, sketch = batch.column(0)[k].values.flatten()
                node, n = node.to_numpy(), n.to_numpy()
                words = min(sketch_bits(int(x), num, den) for x in n) // 64
                rows = np.stack([folded(x, words) for x in sketch.to_pylist()])
                order = np.argsort(node)
                found += [node[order][g] for g in groups(n[order], rows[order], num, den)]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in found], pa.int64()),
                                              C.list_array(found, pa.int64())], names=GROUP.names)
    return run


STAR = StructType([StructField("pivot", LongType()), StructField("node", LongType()), StructField("n", LongType()),
                   StructField("linked", BooleanType()), StructField("delta", BinaryType())])


def _differences(num: int, den: int):
    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                n, hit, delta = [], [], []
                for own, pivot in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                    a, b = np.frombuffer(own, np.uint64), np.frombuffer(pivot, np.uint64)
                    d = np.setxor1d(a, b, assume_unique=True)
                    n.append(len(a))
                    hit.append(bool(linked(len(a), len(b), len(d), num, den)))
                    delta.append(d.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(hit, pa.bool_()),
                     pa.array(delta, pa.binary())], names=STAR.names)
    return run


def forest(n: np.ndarray, deltas: list[np.ndarray], with_pivot: np.ndarray, num: int, den: int) -> list[tuple[int, int]]:
    """Spanning forest (pairs of positions) of the links among a cell's members that the pivot's own
    links leave apart."""
    left = np.flatnonzero(~with_pivot)
    if not len(left):
        return []
    sketch = sketches(deltas, min(8192, sketch_bits(int(n.max()), num, den)))
    sizes = np.fromiter(map(len, deltas), np.int64, len(deltas))
    starts = np.cumsum(sizes) - sizes
    grams, code = np.unique(np.concatenate(deltas), return_inverse=True)
    mark, edges = np.zeros(len(grams), bool), []
    todo = np.flatnonzero(with_pivot).tolist()
    while len(left):
        if not todo:
            todo, left = [int(left[0])], left[1:]
        x = todo.pop()
        bound = np.bitwise_count(sketch[left] ^ sketch[x]).sum(axis=1, dtype=np.int64)
        near = left[linked(n[left], n[x], bound, num, den)]                    # lower bound
        if not len(near):
            continue
        own = code[starts[x]:starts[x] + sizes[x]]
        mark[own] = True
        total = np.concatenate([[0], np.cumsum(sizes[near])])
        at = np.arange(total[-1]) + np.repeat(starts[near] - total[:-1], sizes[near])
        common = np.concatenate([[0], np.cumsum(mark[code[at]])])
        common = common[total[1:]] - common[total[:-1]]
        mark[own] = False
        near = near[linked(n[near], n[x], sizes[near] + sizes[x] - 2 * common, num, den)]      # exact
        edges += [(x, int(y)) for y in near]
        todo += near.tolist()
        left = left[~np.isin(left, near)]
    return edges


EDGE = StructType([StructField("a", LongType()), StructField("b", LongType())])


def _forests(num: int, den: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                members = batch.column(0)[k].values.flatten()          # node, n, linked, delta
                node, n, hit = (m.to_numpy(zero_copy_only=False) for m in members[:3])
                deltas = [np.frombuffer(d, np.uint64) for d in members[3].to_pylist()]
                found = np.array(forest(n, deltas, hit, num, den), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(node[found[:, 0]]), pa.array(node[found[:, 1]])],
                                                 names=EDGE.names)
    return run


def _sets(docs: DataFrame, wanted: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``node, grams`` of the wanted documents (node, key_a, key_b, copies: rows with this set)."""
    texts = docs.select(F.col(text_col).alias("text"), *C.row_keys(id_col, text_col))
    found = (C.join_counted(texts, wanted, ["key_a", "key_b"], "copies")
             .groupBy("node").agg(F.first("text").alias("text")))          # equal rows

    def make():
        cache = WordHashes()
        return lambda batch: [pa.array([gram_hashes(t, words, cache).tobytes() for t in batch], pa.binary())]

    return C.with_text_columns(found, "text", [StructField("grams", BinaryType())], make).drop("text")


def _star(docs: DataFrame, rows: DataFrame, nodes: DataFrame, met: DataFrame, words: int, num: int, den: int,
          id_col: str, text_col: str) -> DataFrame:
    """The exact difference of every member to its pivots: ``pivot, node, n, linked, delta``."""
    pairs = C.shared_table(met.select("pivot", F.explode("members").alias("node")).where("pivot <> node").distinct(),
                           "candidate-pairs")
    # a pivot with many members is copied, and its members dealt over the copies
    pivots = C.shared_table(pairs.groupBy("pivot").agg(F.count(F.lit(1)).alias("k")).withColumn(
        "salts", F.ceil(F.col("k") / STAR_MEMBERS)), "pivots")
    there = pairs.select("node").unionByName(pivots.select(F.col("pivot").alias("node"))).distinct()
    wanted = C.shared_table(rows.select("node", "key_a", "key_b").join(nodes.join(there, "node"), "node"), "wanted-rows")
    sets = C.shared_table(_sets(docs, wanted, words, id_col, text_col), "candidate-sets")
    dealt = (C.join_counted(pairs, pivots, ["pivot"], "k")
             .withColumn("salt", F.pmod(F.xxhash64("node"), "salts")).select("pivot", "node", "salt"))
    copies = (pivots.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
              .join(sets.select(F.col("node").alias("pivot"), F.col("grams").alias("pivot_grams")), "pivot")
              .select("pivot", "salt", "pivot_grams"))
    both = (dealt.join(sets, "node").join(copies, ["pivot", "salt"])
            .select("pivot", "node", "grams", "pivot_grams"))
    return C.shared_table(both.mapInArrow(_differences(num, den), STAR), "differences")


def links(docs: DataFrame, rows: DataFrame, nodes: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN,
          id_col: str = "doc_id", text_col: str = "text", cell: int = CELL) -> DataFrame:
    """Edges (a, b) whose components are those of all links among the sets of ``nodes`` (numbers of
    ``rows``, see ``gram_rows``, and in ``copies`` the rows with their sets)."""
    keys = rows.join(nodes, "node", "left_semi").select(F.explode("cells").alias("cell"), "node", "n")
    met = (keys.repartition("cell").sortWithinPartitions("cell", "node").mapInArrow(_meet(cell), MET))
    met = C.shared_table(met, "met")
    small = C.shared_table(met.where(~F.col("many")).select("members").distinct()
                           .withColumn("no", F.monotonically_increasing_id()), "small-cells")
    near = (small.select("no", F.explode("members").alias("node")).join(rows.select("node", "n", "sketch"), "node")
            .groupBy("no").agg(F.collect_list(F.struct("node", "n", "sketch")).alias("m")).select("m")
            .mapInArrow(_groups(num, den), GROUP).distinct())
    few = C.shared_table(near, "groups")
    many = met.where(F.col("many"))
    star = _star(docs, rows, nodes, few.unionByName(many.select("pivot", "members")), words, num, den, id_col, text_col)
    # of a cell in chunks, members apart from the pivot meet every chunk
    apart = (many.select("cell", "chunk", "pivot", F.explode("members").alias("node"))
             .join(star.where(~F.col("linked")).select("pivot", "node"), ["pivot", "node"])
             .groupBy("cell", "chunk").agg(F.collect_list("node").alias("apart")))
    dealt = (apart.select("cell", "apart").join(many.select("cell", "pivot", "members"), "cell")
             .select("pivot", F.array_union("apart", "members").alias("members")))
    whole = few.where(F.size("members") > 2).select("pivot", "members").unionByName(dealt)
    whole = C.shared_table(whole.withColumn("no", F.monotonically_increasing_id()), "cells")
    members = whole.select("no", "pivot", F.explode("members").alias("node")).join(star, ["pivot", "node"])
    open_ = members.groupBy("no").agg(F.bool_and("linked").alias("done"), F.count(F.lit(1)).alias("k"))
    open_ = open_.where(~F.col("done") & (F.col("k") > 1)).select("no")
    inside = (members.join(open_, "no", "left_semi").groupBy("no")
              .agg(F.collect_list(F.struct("node", "n", "linked", "delta")).alias("m")).select("m")
              .mapInArrow(_forests(num, den), EDGE))
    direct = star.where("linked").select(F.col("pivot").alias("a"), F.col("node").alias("b"))
    return direct.unionByName(inside)


def near_sets(docs: DataFrame, words: int = WORDS, num: int = NUM, den: int = DEN, id_col: str = "doc_id",
              text_col: str = "text", cell: int = CELL) -> DataFrame:
    """``id_col``, ``n_grams`` (size of the set) and ``component_id``, the smallest id that is
    reachable by links."""
    rows = C.shared_table(gram_rows(docs, words, num, den, id_col, text_col), "gram-rows")
    sets = C.shared_table(rows.where("n > 0").groupBy("set_a", "set_b").agg(
        F.min("node").alias("node"), F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies")), "sets")
    edges = links(docs, rows, sets.select("node", "copies"), words, num, den, id_col, text_col, cell)
    roots = components(edges).withColumnRenamed("root", "set_root")
    rooted = C.shared_table(sets.join(roots, "node", "left").withColumn(
        "set_root", F.coalesce("set_root", "node")), "rooted-sets")
    least = C.shared_table(rooted.groupBy("set_root").agg(F.min("least_id").alias("component_id"),
                                                          F.count(F.lit(1)).alias("k")), "least-ids")
    classes = C.shared_table(C.join_counted(rooted, least, ["set_root"], "k")
                             .select("set_a", "set_b", "component_id", "copies"), "set-classes")
    some = C.join_counted(rows.where("n > 0").select("id", "n", "set_a", "set_b"), classes,
                          ["set_a", "set_b"], "copies")
    none = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return some.select("id", "n", "component_id").unionByName(none).select(
        F.col("id").alias(id_col), F.col("n").alias("n_grams"), "component_id")


OP12_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < {WORDS} THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(ws[i : i + {WORDS - 1}], ' ') FOR i IN range(1, len(ws) - {WORDS - 2})] END) AS gram FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT DISTINCT doc_id, hash(gram) AS h FROM g),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM c AS a JOIN c AS b ON a.h = b.h AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b
      WHERE {DEN} * k >= {NUM} * (x.n + y.n - k)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS root FROM documents
      UNION SELECT u.b, r.root FROM r JOIN u ON u.a = r.doc_id WHERE r.root < u.b)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM documents AS d LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(root) AS component_id FROM r GROUP BY 1) AS m USING (doc_id)
"""
