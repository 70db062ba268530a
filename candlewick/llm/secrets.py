"""Secret scans with character Markov models, in DataFrame functions only.

Base patterns find assignments, access keys and hex runs. Two first-order Markov models over
characters, one of random strings and one of ordinary identifiers, then score every other long
token by its mean log-likelihood ratio per step; tokens above ``THRESHOLD`` are added as kind
``markov``, unless they overlap a base span.

Training samples are labelled by the base patterns: the values they match in about
``TRAIN_SECRETS`` documents are random strings, the identifiers outside of them in about
``TRAIN_NAMES`` documents are ordinary (documents are chosen by a hash of the id). Only the two
tables of step counts (64 x 64 cells at most each) reach the driver. With no sample at all both
models are uniform, all ratios are 0 and nothing is added.

Null and empty texts have no spans. Repeated rows and ties are scanned alike; long texts are
scanned whole; extra columns stay, and those named as an added column are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from candlewick.llm import common as C

# The base patterns. Runs of access keys and hex digits are maximal, so their least
# length can stand in the pattern; that of an assigned value is checked after the match.
ASSIGN = ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api")
LEAST_VALUE = 12
TOKEN_CHARS = "A-Za-z0-9+/_=-"
LEAST_TOKEN = 16
CANDIDATE = f"(?<![{TOKEN_CHARS}])[{TOKEN_CHARS}]{{{LEAST_TOKEN},}}"
IDENTIFIER = "[A-Za-z_][A-Za-z0-9_]{7,}"
ALPHABET = 67
THRESHOLD = 0.5
TRAIN_SECRETS, TRAIN_NAMES = 50_000, 2_000
SPAN = "array<struct<start:bigint,end:bigint>>"
ROW = "array<struct<start:bigint,kind:int,end:bigint>>"


def places(text: Column, found: Column, pattern: str, keep: Column | None = None) -> Column:
    """Code-point spans of the matches ``found`` of ``pattern`` (with ``keep``, an array of flags,
    of the flagged ones): the pieces between them and their own lengths add up to their places.
    The text is split once, outside of the fold, so the work is linear in its length."""
    gaps = F.transform(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)),
                       lambda x: F.char_length(x).cast("long"))
    pieces = F.zip_with(gaps, found, lambda gap, match: F.struct(
        gap.alias("gap"), F.char_length(match).cast("long").alias("size")))
    flags = F.transform(found, lambda _: F.lit(True)) if keep is None else keep
    pieces = F.zip_with(pieces, flags, lambda p, k: F.struct(
        p["gap"].alias("gap"), p["size"].alias("size"), k.alias("keep")))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc: Column, p: Column) -> Column:
        first = acc["at"] + p["gap"]
        end = first + p["size"]
        span = F.array(F.struct(first.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(p["keep"], F.concat(acc["spans"], span))
                        .otherwise(acc["spans"]).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(pieces, start, add, lambda acc: acc["spans"])
                  ).otherwise(F.array().cast(SPAN))


def codes(string: Column) -> Column:
    """Codes of an ASCII string's characters, in one pass over it."""
    return F.transform(F.split(string, ""), lambda c: F.ascii(c))


def _extract(text: Column, pattern: str, group: int, when: Column | None = None) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    none = F.array().cast("array<string>")
    return found if when is None else F.when(when, found).otherwise(none)


def base_matches(docs: DataFrame, text_col: str) -> DataFrame:
    """Append the matches of the base patterns (group 0; for assignments the value too)."""
    low = F.lower("_text")
    assign = None
    for w in ASSIGN_WORDS:          # plain searches are cheaper than the pattern
        assign = low.contains(w) if assign is None else assign | low.contains(w)
    return (docs.withColumn("_text", F.coalesce(F.col(text_col), F.lit("")))
            .withColumns({"_assign": _extract(F.col("_text"), ASSIGN, 0, assign),
                          "_value": _extract(F.col("_text"), ASSIGN, 2, assign),
                          "_access": _extract(F.col("_text"), ACCESS, 0, F.col("_text").contains("AKIA")),
                          "_hex": _extract(F.col("_text"), HEX, 0)}))


def steps(samples: DataFrame) -> DataFrame:
    """``kind, a, b, n``: how often code b follows code a in the strings (kind, s)."""
    long_enough = samples.where(F.char_length("s") > 1).select("kind", codes(F.col("s")).alias("c"))
    rest = F.size("c") - 1
    pair = F.zip_with(F.slice("c", F.lit(1), rest), F.slice("c", F.lit(2), rest),
                      lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return (long_enough.select("kind", F.explode(pair).alias("x"))
            .groupBy("kind", F.col("x.a").alias("a"), F.col("x.b").alias("b"))
            .agg(F.count(F.lit(1)).alias("n")))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log-likelihood ratio of every step a -> b, at 128 * a + b."""
    n = docs.count()
    u = (F.xxhash64(F.lit("secrets"), F.col(id_col).cast("string"))
         .bitwiseAND((1 << 53) - 1).cast("double") / float(1 << 53))
    docs = docs.select(F.col(text_col).alias("text"), (u * n).alias("rank"))
    docs = docs.where(F.col("rank") < TRAIN_SECRETS)
    found = base_matches(docs, "text")
    value = F.filter("_value", lambda v: F.char_length(v) >= LEAST_VALUE)
    secret = found.select(F.explode(F.concat(value, "_access", "_hex")).alias("s"))
    bare = F.col("_text")
    for p in (ASSIGN, ACCESS, HEX):
        bare = F.regexp_replace(bare, p, " ")
    plain = (found.where(F.col("rank") < TRAIN_NAMES)
             .select(F.explode(F.regexp_extract_all(bare, F.lit(IDENTIFIER), F.lit(0))).alias("s")))
    inside = f"[^{TOKEN_CHARS}]"
    both = (secret.select(F.lit(1).alias("kind"), F.regexp_replace("s", inside, "").alias("s"))
            .unionByName(plain.select(F.lit(0).alias("kind"), "s")))
    count: list[dict] = [{}, {}]
    total: list[dict] = [{}, {}]
    for r in steps(both).collect():
        count[r["kind"]][r["a"], r["b"]] = r["n"]
        total[r["kind"]][r["a"]] = total[r["kind"]].get(r["a"], 0) + r["n"]

    def log_p(kind: int, a: int, b: int) -> float:
        return math.log((count[kind].get((a, b), 0) + 1) / (total[kind].get(a, 0) + ALPHABET))

    return [log_p(1, a, b) - log_p(0, a, b) for a in range(128) for b in range(128)]


def ratio(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio per step of an ASCII token, in one pass over it."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def add(acc: Column, code: Column) -> Column:
        more = F.when(acc["last"] < 0, 0.0).otherwise(F.get(table, acc["last"] * 128 + code))
        return F.struct(code.alias("last"), (acc["sum"] + more).alias("sum"))

    total = F.aggregate(codes(token), start, add, lambda acc: acc["sum"])
    return total / (F.char_length(token) - 1)


def _kind(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"),
                                                 s["end"].alias("end")))


def scan(docs: DataFrame, table: list[float], threshold: float = THRESHOLD,
         text_col: str = "text") -> DataFrame:
    """Append ``base_spans`` and ``secret_spans`` (with the model's), arrays of (start, kind,
    end) in order; kind indexes ``KINDS``."""
    base = C.without(docs, ["base_spans", "secret_spans"])
    # one literal: a split string folds into a constant array
    ratios = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
    m = base_matches(base, text_col).withColumn("_token", _extract(F.col("_text"), CANDIDATE, 0))
    m = m.withColumn("_score", F.transform("_token", lambda t: ratio(t, ratios)))
    text = F.col("_text")
    long_value = F.transform("_value", lambda v: F.char_length(v) >= LEAST_VALUE)
    m = m.withColumns({
        "_assign": places(text, F.col("_assign"), ASSIGN, long_value),
        "_access": places(text, F.col("_access"), ACCESS),
        "_hex": places(text, F.col("_hex"), HEX),
        "_token": F.when(F.exists("_score", lambda x: x > threshold),
                         places(text, F.col("_token"), CANDIDATE,
                                F.transform("_score", lambda x: x > threshold)))
        .otherwise(F.array().cast(SPAN))})
    m = m.withColumn("base_spans", F.array_sort(F.concat(
        *[_kind(F.col(c), k) for k, c in enumerate(("_assign", "_access", "_hex"))])).cast(ROW))
    fresh = F.filter("_token", lambda t: ~F.exists(
        "base_spans", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    m = m.withColumn("secret_spans", F.array_sort(F.concat("base_spans", _kind(fresh, 3))).cast(ROW))
    return m.select(*[F.col(f"`{c}`") for c in base.columns], "base_spans", "secret_spans")


def span_text(spans: str) -> Column:
    """``kind:start:end`` of all spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
