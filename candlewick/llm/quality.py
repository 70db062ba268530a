"""Quality rules with cross-document line frequency.

One Arrow pass measures every text and hashes its normalised lines (words lower-cased A-Z,
joined by one space). Distinct documents are counted for each (host, line hash); lines found in
``least_documents`` or more of a host's documents that are also ``host_percent`` or more of them are
removed from all of that host's documents, whatever the host's size. A document
that keeps less than ``least_share`` of its words, or fewer than ``least_words``, is depleted and
rejected, as is one that fails the base rules.

Each row counts as one document. Null texts and texts without words fail the base rules; a null
host is a host of its own; ties and repeated rows are counted like other rows; very long texts
are measured whole. An empty table gives an empty result. Columns other than id, text and host
are not carried.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ArrayType, BooleanType, IntegerType, LongType, StructField)

from candlewick.llm import common as C

#: So many documents of one host, and so large a share of them in percent, make a line boilerplate.
LEAST_DOCUMENTS, HOST_PERCENT = 10, 5
LEAST_SHARE, LEAST_WORDS = 0.5, 20
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SYMBOLS = re.compile(rb"[#*$%&|<>]")
CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words that stand in a 3-word window found twice or more in the text."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = np.unique(ids[:-1] * len(seen) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(seen) + ids[2:]
    _, which, count = np.unique(windows, return_inverse=True, return_counts=True)
    hit = count[which] > 1
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k:len(hit) + k] |= hit
    return int(covered.sum())


def measure(text: bytes) -> tuple:
    """(words, word characters, symbols, equal lines, repeated words, lines): the lines that
    have a word as (number, hash, words, first of its hash in the text)."""
    words = text.split()
    bare = b"".join(words)
    raw, hashes, lines, equal = set(), set(), [], 0
    for number, line in enumerate(text.split(b"\n")):
        parts = line.split()
        if not parts:
            continue
        equal += line in raw
        raw.add(line)
        h = xxhash.xxh3_64_intdigest(b" ".join(parts).translate(LOWER)) - (1 << 63)
        lines.append((number, h, len(parts), h not in hashes))
        hashes.add(h)
    return (len(words), len(bare.translate(None, CONTINUATION)), len(SYMBOLS.findall(text)), equal,
            repeated_words(words), lines)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINE_FIELDS = (("line_no", IntegerType(), pa.int32()), ("line_hash", LongType(), pa.int64()),
               ("line_words", IntegerType(), pa.int32()), ("line_first", BooleanType(), pa.bool_()))


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Append the measures of every text and the arrays that describe its lines."""
    fields = [StructField(n, LongType()) for n in MEASURES]
    fields += [StructField(n, ArrayType(t)) for n, t, _ in LINE_FIELDS]

    def run(texts):
        rows = [measure(t) for t in texts]
        out = [pa.array([r[k] for r in rows], pa.int64()) for k in range(len(MEASURES))]
        return out + [pa.array([[x[k] for x in r[5]] for r in rows], pa.list_(kind))
                      for k, (_, _, kind) in enumerate(LINE_FIELDS)]

    return C.with_text_columns(docs, text_col, fields, lambda: run)


def base_failed() -> F.Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def quality_rules(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, host_percent: int = HOST_PERCENT, least_share: float = LEAST_SHARE,
                  least_words: int = LEAST_WORDS, id_col: str = "doc_id",
                  text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``id_col``, the measures, ``removed_lines`` (numbers from 0), ``words_left``,
    ``base_failed`` and ``kept``."""
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.xxhash64(F.isnull(host_col).cast("string"), host_col).alias("host"))
    rows = C.shared_table(measured(narrow).drop("text")
                          .withColumn("row_id", F.monotonically_increasing_id()), "measured")
    lines = rows.select("row_id", "host", F.explode(F.arrays_zip(*[n for n, _, _ in LINE_FIELDS]))
                        .alias("x")).select("row_id", "host", "x.*")
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("host_documents"))
    counts = (lines.where("line_first").groupBy("host", "line_hash").agg(F.count(F.lit(1)).alias("documents"))
              .where(F.col("documents") >= least_documents))
    frequent = C.shared_table(
        counts.join(hosts, "host").where(100 * F.col("documents") >= host_percent * F.col("host_documents"))
        .select("host", "line_hash"), "frequent-lines")
    removed = (lines.join(frequent, ["host", "line_hash"]).groupBy("row_id")
               .agg(F.array_sort(F.collect_list("line_no")).alias("removed_lines"),
                    F.sum("line_words").alias("words_removed")))
    out = rows.join(removed, "row_id", "left")
    left = F.col("n_words") - F.coalesce("words_removed", F.lit(0))
    depleted = (left < least_words) | (left < least_share * F.col("n_words"))
    return out.select(F.col("id").alias(id_col), *MEASURES,
                      F.coalesce("removed_lines", F.array().cast("array<int>")).alias("removed_lines"),
                      left.alias("words_left"), base_failed().alias("base_failed"),
                      (~base_failed() & ~depleted).alias("kept"))


OP10_SQL = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM t),
l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS no FROM t),
lw AS (SELECT *, regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+') AS ws FROM l),
n AS (SELECT doc_id, source, line, len(ws) AS k,
             translate(array_to_string(ws, ' '), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                       'abcdefghijklmnopqrstuvwxyz') AS norm FROM lw WHERE len(ws) > 0),
hd AS (SELECT source, count(DISTINCT doc_id) AS k FROM documents GROUP BY 1),
f AS (SELECT c.source, norm FROM (SELECT source, norm, count(DISTINCT doc_id) AS k FROM n GROUP BY 1, 2) AS c
      JOIN hd ON hd.source IS NOT DISTINCT FROM c.source
      WHERE c.k >= {LEAST_DOCUMENTS} AND 100 * c.k >= {HOST_PERCENT} * hd.k),
r AS (SELECT doc_id, sum(k) AS gone FROM n JOIN f ON n.norm = f.norm AND n.source IS NOT DISTINCT FROM f.source
      GROUP BY 1),
d AS (SELECT doc_id, count(*) - count(DISTINCT line) AS dup FROM n GROUP BY 1),
u AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
g AS (SELECT doc_id, i, word, lead(word, 1) OVER p AS b, lead(word, 2) OVER p AS c FROM u
      WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
h AS (SELECT doc_id, i, CASE WHEN c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, word, b, c) > 1
             THEN 1 ELSE 0 END AS hit FROM g),
q AS (SELECT doc_id, sum(greatest(hit, x1, x2)) AS rep FROM (
      SELECT doc_id, hit, coalesce(lag(hit, 1) OVER p, 0) AS x1, coalesce(lag(hit, 2) OVER p, 0) AS x2 FROM h
      WINDOW p AS (PARTITION BY doc_id ORDER BY i)) GROUP BY 1),
s AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(rep, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(ws) - coalesce(gone, 0) AS BIGINT) AS words_left
      FROM w LEFT JOIN d USING (doc_id) LEFT JOIN q USING (doc_id) LEFT JOIN r USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND words_left >= {LEAST_WORDS} AND words_left >= {LEAST_SHARE} * n_words AS kept
FROM s
"""
