"""Language ID by hierarchical discrimination.

Texts are lower-cased and seen as letter trigrams (other code points count as a space), hashed
to ``BUCKETS``. Linear support vector machines, one for each pair, first separate the families of
the learned languages, then the languages within the winning family. Votes decide, margins break
ties.

Machines are fitted on a sample of labelled rows: about ``ROWS_PER_LANGUAGE`` of each language
(all, if it has fewer), chosen by a hash of the id. Each pair is trained in a task of its own on
its part of the sample (dual coordinate descent); only the weights reach the driver. Predictions
read the text alone.

Null texts and texts without a letter are ``und`` with score 0, as is every text if no language
was learned. Rows with a null label are not learned from. Repeated rows and ties get equal
predictions; whole texts are read, however long; extra columns stay, and those named as an added
column are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (ArrayType, DoubleType, FloatType, IntegerType, StringType,
                               StructField, StructType)

from candlewick.llm import common as C

BUCKETS, ROWS_PER_LANGUAGE, EPOCHS, COST, SCALE = 1 << 13, 1000, 20, 10.0, 30.0
# Families of common languages; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "da", "sv", "no", "nb", "nn", "is", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "mk", "sr", "hr", "bs", "sl", "cs", "sk", "pl"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur", "si"),
    "turkic": ("tr", "az", "kk", "ky", "uz", "tt"),
    "uralic": ("fi", "et", "hu"),
    "semitic": ("ar", "he", "mt"),
    "iranian": ("fa", "ps", "ku", "tg"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "cy", "br", "gd"),
    "austronesian": ("id", "ms", "jv", "tl"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


class Trigrams:
    """Hashed letter trigrams of texts; built once a task."""

    def __init__(self):
        self.letter = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of all texts' trigrams with a letter in the middle, and how many each has."""
        low = [t.decode().lower() for t in texts]
        # a space on both sides keeps trigrams within their text
        code = np.frombuffer("".join(f" {t} " for t in low).encode("utf-32-le"), np.uint32)
        is_letter = self.letter[code]
        code = np.where(is_letter, code, np.uint32(32))
        mid = np.flatnonzero(is_letter)
        x = (code[mid - 1] * np.uint32(0x9E3779B1) ^ code[mid] * np.uint32(0x85EBCA77)
             ^ code[mid + 1] * np.uint32(0xC2B2AE3D))
        x = (x ^ x >> np.uint32(15)) * np.uint32(0x27D4EB2F)
        ends = np.cumsum(np.fromiter((len(t) + 2 for t in low), np.int64, len(low)))
        return (x >> np.uint32(32 - 13)).astype(np.int64), np.diff(np.searchsorted(mid, ends), prepend=0)


def sums_by_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


@dataclass(frozen=True)
class Model:
    """Families with their languages, and a weight vector (bias last) for each pair: positive
    margins are for the first of the pair."""
    families: dict[str, list[str]]
    weights: dict[tuple[str, str, str], np.ndarray]

    def choose(self, level: str, names: list[str], margins: dict) -> tuple[np.ndarray, np.ndarray]:
        """Winner of each text among ``names`` and its least margin over the others."""
        n = len(next(iter(margins.values()))) if margins else 0
        votes, total = np.zeros((2, len(names), n))
        least = np.full((len(names), n), np.inf)
        for i, j in combinations(range(len(names)), 2):
            m = margins[level, names[i], names[j]]
            for k, own in ((i, m), (j, -m)):
                votes[k] += own > 0
                total[k] += own
                least[k] = np.minimum(least[k], own)
        best = np.lexsort((total, votes), axis=0)[-1] if n else np.zeros(0, np.int64)
        return best, least[best, np.arange(n)]

    def predict(self, buckets: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray]:
        per = SCALE / np.maximum(sizes, 1)
        margins = {k: sums_by_text(w[:-1][buckets], sizes) * per + w[-1]
                   for k, w in self.weights.items()}
        margins[None] = np.zeros(len(sizes))
        names = sorted(self.families)
        if not names:
            return ["und"] * len(sizes), np.zeros(len(sizes))
        family, sure = self.choose("family", names, margins)
        inner = {f: self.choose(f, self.families[f], margins) for f in names}
        langs, scores = [], np.zeros(len(sizes))
        for k, n in enumerate(sizes.tolist()):
            f = names[family[k]]
            lang, own = inner[f]
            langs.append(self.families[f][lang[k]] if n else "und")
            m = min(sure[k], own[k], 50.0)
            scores[k] = 1 / (1 + np.exp(-m)) if n else 0.0
        return langs, scores


def train_pair(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> np.ndarray:
    """Weights (bias last) of an L2-loss linear SVM by dual coordinate descent over sparse rows
    (buckets, values)."""
    rows = [(np.append(k, BUCKETS), np.append(v, 1.0)) for k, v in rows]
    norm = [float(v @ v) + 0.5 / COST for _, v in rows]
    w, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    rng = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, value = rows[i]
            g = y[i] * float(w[at] @ value) - 1 + alpha[i] * 0.5 / COST
            new = max(0.0, alpha[i] - g / norm[i])
            if new != alpha[i]:
                w[at] += (new - alpha[i]) * y[i] * value
                alpha[i] = new
    return w


def held_out(id_col: str = "doc_id") -> Column:
    """True for ids whose crc32 as text leaves 2 modulo 4 (null ids: false)."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(4)) == 2, F.lit(False))


def sample(labelled: DataFrame, rows: int, id_col: str, label_col: str) -> DataFrame:
    """About ``rows`` rows of each label, by a hash of the id (each label's share of the hash
    range follows from its count)."""
    sizes = labelled.groupBy(label_col).agg(F.count(F.lit(1)).alias("label_rows"))
    u = (F.xxhash64(F.lit("sample"), F.col(id_col).cast("string"))
         .bitwiseAND((1 << 53) - 1).cast("double") / float(1 << 53))
    # one row a label: far below any broadcast bound
    return labelled.join(F.broadcast(sizes), label_col).where(u * F.col("label_rows") < rows)


def fit(labelled: DataFrame, rows: int = ROWS_PER_LANGUAGE, id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "lang") -> Model:
    slim = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(label_col).alias("lang")).where("lang is not null and text is not null")
    chosen = sample(slim, rows, "id", "lang").select("id", "lang", "text")

    def features():
        trigrams = Trigrams()

        def run(texts):
            buckets, sizes = trigrams(texts)
            cuts = np.cumsum(sizes)[:-1]
            found = [np.unique(b, return_counts=True) for b in np.split(buckets, cuts)]
            return [C.list_array([f[0] for f in found], pa.int32()),
                    C.list_array([SCALE * f[1] / max(1, f[1].sum()) for f in found], pa.float32())]
        return run

    vectors = C.shared_table(C.with_text_columns(
        chosen, "text", [StructField("bucket", ArrayType(IntegerType())),
                         StructField("value", ArrayType(FloatType()))], features)
        .where(F.size("bucket") > 0).drop("text"), "language-sample")
    langs = sorted(r["lang"] for r in vectors.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family_of(lang), []).append(lang)
    pairs = [("family", a, b) for a, b in combinations(sorted(families), 2)]
    pairs += [(f, a, b) for f, members in families.items() for a, b in combinations(members, 2)]
    if not pairs:
        return Model(families, {})
    sides = [(str(k), lang, float(sign)) for k, (level, *ends) in enumerate(pairs)
             for sign, end in zip((1, -1), ends)
             for lang in (families[end] if level == "family" else [end])]
    plan = labelled.sparkSession.createDataFrame(sides, "pair string, lang string, side double")
    schema = StructType([StructField("pair", StringType()), StructField("weight", ArrayType(FloatType()))])

    def train(table: pa.Table) -> pa.Table:
        order = np.argsort(np.array([str(v) for v in table.column("id").to_pylist()]), kind="stable")
        table = table.take(pa.array(order)).combine_chunks()
        bucket, value = (table.column(n).combine_chunks() for n in ("bucket", "value"))
        cuts = np.cumsum(bucket.value_lengths().to_numpy())[:-1]
        rows = list(zip(np.split(bucket.flatten().to_numpy(), cuts), np.split(value.flatten().to_numpy(), cuts)))
        w = train_pair(rows, table.column("side").to_numpy())
        return pa.table({"pair": table.column("pair").slice(0, 1),
                         "weight": pa.array([w.tolist()], pa.list_(pa.float32()))})

    fitted = (vectors.join(F.broadcast(plan), "lang").groupBy("pair").applyInArrow(train, schema).collect())
    return Model(families, {pairs[int(r["pair"])]: np.array(r["weight"], np.float32) for r in fitted})


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """Append ``lang_pred`` and ``score`` (logistic of the winner's least margin)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        trigrams = Trigrams()

        def run(texts):
            langs, scores = shared.value.predict(*trigrams(texts))
            return [pa.array(langs, pa.string()), pa.array(scores)]
        return run

    return C.with_text_columns(docs, text_col, [StructField("lang_pred", StringType()),
                                                StructField("score", DoubleType())], make)
