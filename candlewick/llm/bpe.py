"""BPE encoding and decoding with a lexicon of frequent words.

1. Pieces of all texts are counted; the most frequent ones, at most ``max_words`` of them, go
   with their ids into a minimal acyclic transducer (``lexicon.py``), one file that every task
   maps into memory.
2. Texts are split into pieces; known pieces take their ids from the transducer, all others are
   merged by rank, exactly as the vocabulary says.

Nulls and empty texts give no ids; special tokens that stand in a text become their ids. Any
text round-trips: ids decode to the same bytes. Repeated rows are encoded like any other, extra
columns stay, and columns named as the added ones are replaced. An empty table gives an empty
result (the lexicon is empty then).
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, IntegerType, LongType, StringType, StructField,
                               StructType)

from candlewick.llm import common as C
from candlewick.llm.lexicon import Lexicon, compile_lexicon

#: Bounds of the lexicon: words, and bytes of a word.
MAX_WORDS, LONGEST_WORD = 1 << 18, 48
#: Bounds of what a task keeps: counted pieces, and merged pieces from outside the lexicon.
KEEP = 200_000
# The piece pattern of byte-level BPE vocabularies.
PIECES = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
          r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+")


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable bytes stand for
    themselves, all others take the letters from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Merge ranks and token bytes of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, ids = byte_letters(), spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [b""] * (1 + max([*ids.values(), *self.special.values()]))
        for token, i in ids.items():
            self.tokens[i] = bytes(letters[x] for x in token)
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.byte_id = [0] * 256
        for letter, b in letters.items():
            self.byte_id[b] = ids[letter]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(ids[a], ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.merged = [ids[a + b] for a, b in pairs]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one piece: the pair of lowest rank, leftmost first, is merged until none is
        left; a heap of pairs over a linked list keeps long pieces near-linear."""
        ids = [self.byte_id[b] for b in word]
        if len(ids) > 40:
            return self._merge_long(ids)
        none, rank = len(self.merged), self.rank.get
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (best := min(ranks)) < none:
            k = ranks.index(best)
            ids[k:k + 2] = [self.merged[best]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), none)
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        after = [*range(1, len(ids)), -1]
        before = [-1, *range(len(ids) - 1)]
        heap = [(self.rank[pair], k, pair) for k, pair in enumerate(zip(ids, ids[1:]))
                if pair in self.rank]
        heapq.heapify(heap)
        while heap:
            best, k, pair = heapq.heappop(heap)
            nxt = after[k]
            if nxt < 0 or (ids[k], ids[nxt]) != pair:
                continue
            ids[k], ids[nxt], after[k] = self.merged[best], -1, after[nxt]
            if after[nxt] >= 0:
                before[after[nxt]] = k
            for left in (before[k], k):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (pair := (ids[left], ids[right])) in self.rank:
                    heapq.heappush(heap, (self.rank[pair], left, pair))
        return [i for i in ids if i >= 0]


#: UTF-8 bytes below this one encode code points below U+0240 only.
NEAR_BYTE, NEAR = 0xC9, 0x240


def near_pattern() -> str:
    """``PIECES`` for code points below ``NEAR``, with its classes spelled out for the faster
    ``re`` module."""
    members = {"L": "", "N": ""}
    for c in map(chr, range(NEAR)):
        kind = unicodedata.category(c)[0]
        members[kind] = members.get(kind, "") + re.escape(c)
    letter, number, space = members["L"], members["N"], r"\t-\r \x85\xa0"
    return (PIECES.replace(r"[^\p{White_Space}\p{L}\p{N}]", f"[^{space}{letter}{number}]")
            .replace(r"\p{L}", f"[{letter}]").replace(r"\p{N}", f"[{number}]")
            .replace(r"\p{White_Space}", f"[{space}]").replace(r"\P{White_Space}", f"[^{space}]"))


def splitter(special: list[str]):
    """Function from a text's UTF-8 bytes to its pieces; special tokens are pieces of their own."""
    any_pieces, near_pieces = regex.compile(PIECES).findall, re.compile(near_pattern()).findall
    cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def split(data: bytes) -> list[str]:
        text = data.decode()
        near = not data or np.frombuffer(data, np.uint8).max() < NEAR_BYTE
        pieces = near_pieces if near else any_pieces
        if cut is None or not any(s in text for s in special):
            return pieces(text)
        out = []
        for k, part in enumerate(cut.split(text)):
            out += [part] if k % 2 else pieces(part)
        return out

    return split


def piece_counts(docs: DataFrame, vocab: Vocabulary, text_col: str = "text") -> DataFrame:
    """``piece, n`` over all texts; counted within each task before the shuffle."""
    special = list(vocab.special)

    def run(batches):
        split, seen = splitter(special), Counter()

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()),
                                               pa.array(list(seen.values()), pa.int64())],
                                              names=["piece", "n"])
        for batch in batches:
            for part in C.slices(batch, 0):
                for t in C.texts_of(part, 0):
                    seen.update(split(t))
                if len(seen) > KEEP:
                    yield rows()
                    seen.clear()
        yield rows()

    schema = StructType([StructField("piece", StringType()), StructField("n", LongType())])
    return (docs.select(text_col).mapInArrow(run, schema).groupBy("piece")
                .agg(F.sum("n").alias("n")))


def build_lexicon(docs: DataFrame, vocab: Vocabulary, text_col: str = "text",
                  max_words: int = MAX_WORDS) -> str:
    """Compile the most frequent pieces into a transducer file in the shared folder; returns
    its name for ``local_file``. All pieces down to the smallest count that keeps the number
    within ``max_words`` enter, so what reaches the driver is bounded by that parameter."""
    spark = docs.sparkSession
    counts = C.shared_table(
        piece_counts(docs, vocab, text_col)
        .where((F.col("n") > 1) & (F.octet_length("piece") <= LONGEST_WORD)), "pieces")
    per_count = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    above = (per_count.withColumn("level", F.floor(F.log2("n") * 64))
             .groupBy("level").agg(F.sum("words").alias("words"), F.min("n").alias("n")))
    total, least = 0, None               # a row for each 64th of a doubling, 4096 at most
    for row in sorted(above.collect(), key=lambda r: -r["level"]):
        total += row["words"]
        if total > max_words:
            break
        least = row["n"]
    words = [] if least is None else counts.where(F.col("n") >= least).select("piece").collect()
    special = vocab.special
    return C.put_file(spark, "lexicon", compile_lexicon(
        {(w := r["piece"].encode()): [special[r["piece"]]] if r["piece"] in special
         else vocab.merge(w) for r in words}))


class Encoder:
    """Texts to ids within one task."""

    def __init__(self, vocab: Vocabulary, lexicon: Lexicon):
        self.vocab, self.lexicon = vocab, lexicon
        self.split = splitter(list(vocab.special))
        self.known: dict[str, bytes] = {}
        self.merged: list[str] = []          # known pieces from outside the lexicon

    def __call__(self, texts: list[bytes]) -> list[np.ndarray]:
        pieces = [self.split(t) for t in texts]
        if len(self.merged) > KEEP:
            for piece in self.merged:
                del self.known[piece]
            self.merged = []
        new = list(set(chain.from_iterable(pieces)).difference(self.known))
        raw = [w.encode() for w in new]
        special, known = self.vocab.special, self.known
        for piece, word, rank in zip(new, raw, self.lexicon.find(raw).tolist()):
            if rank >= 0:
                known[piece] = self.lexicon.ids_of(rank).tobytes()
            else:
                ids = [special[piece]] if piece in special else self.vocab.merge(word)
                known[piece] = array("i", ids).tobytes()
                self.merged.append(piece)
        return [np.frombuffer(b"".join(map(known.__getitem__, p)), np.int32) for p in pieces]


class Decoder:
    """Ids to texts; ids outside the vocabulary give nothing, bad UTF-8 its replacement."""

    def __init__(self, vocab: Vocabulary):
        self.size = np.array([len(t) for t in vocab.tokens] + [0], np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(vocab.tokens), np.uint8)

    def __call__(self, rows: list[np.ndarray]) -> list[str]:
        out = []
        for ids in rows:
            ids = np.where((ids >= 0) & (ids < len(self.size) - 1), ids, len(self.size) - 1)
            size = self.size[ids]
            end = np.cumsum(size)
            at = np.repeat(self.first[ids] - (end - size), size) + np.arange(size.sum())
            out.append(self.bytes[at].tobytes().decode("utf-8", "replace"))
        return out


def encode(docs: DataFrame, vocab: Vocabulary, lexicon: str, text_col: str = "text",
           ids_col: str = "ids", decoded_col: str | None = None) -> DataFrame:
    """Append the ids of every text and, where ``decoded_col`` is given, the text decoded from
    those ids in the same pass."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    fields = [StructField(ids_col, ArrayType(IntegerType()))]
    fields += [StructField(decoded_col, StringType())] if decoded_col else []

    def make():
        encoder = Encoder(shared.value, Lexicon(C.local_file(lexicon)))
        decoder = Decoder(shared.value)

        def run(texts):
            ids = encoder(texts)
            out = [C.list_array(ids, pa.int32())]
            return out + ([pa.array(decoder(ids), pa.string())] if decoded_col else [])

        return run

    return C.with_text_columns(docs, text_col, fields, make)


def decode(df: DataFrame, vocab: Vocabulary, ids_col: str = "ids",
           text_col: str = "decoded") -> DataFrame:
    """Append the text of an id array (null ids: empty text)."""
    shared = df.sparkSession.sparkContext.broadcast(vocab)
    base = C.without(df, [text_col])
    at, names = base.columns.index(ids_col), [*base.columns, text_col]

    def run(batches):
        decoder = Decoder(shared.value)
        for batch in batches:
            rows = [np.array([i for i in x or [] if i is not None], np.int64)
                    for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoder(rows), pa.string())], names=names)

    return base.mapInArrow(run, StructType([*base.schema.fields,
                                            StructField(text_col, StringType())]))
