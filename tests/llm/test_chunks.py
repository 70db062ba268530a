import hashlib
import random

from candlewick.llm import chunks as K, queries as Q, successors


def slow_chunks(text: bytes):
    """Byte-by-byte normalised chunking: distinct chunks as (48 bits of digest, length)."""
    out, start = set(), 0
    while start < len(text):
        end = min(len(text), start + K.LONGEST)
        for i in range(start, end):
            size = i + 1 - start
            h = sum(int(K.GEAR[text[i - k]]) << k for k in range(min(32, i + 1))) % (1 << 32)
            bits = K.STRICT_BITS if size <= K.NORMAL else K.LOOSE_BITS
            if size >= K.SHORTEST and h < 1 << 32 - bits:
                end = i + 1
                break
        part = text[start:end]
        out.add((K.xxhash.xxh3_64_intdigest(part) >> 16, len(part)))
        start = end
    return out


def slow_text(chunks):
    letters = sorted("-_" + "".join(chr(c) for c in range(128) if chr(c).isalnum()))
    out = []
    for digest, size in sorted(chunks):
        n, word = digest * 64 + size, ""
        for _ in range(9):
            n, r = divmod(n, 64)
            word = letters[r] + word
        out.append(word)
    return "".join(out)


def slow_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    size = lambda x: sum(n for _, n in x)
    return size(a & b) / min(size(a), size(b))


def brute(rows):
    """rows: (id, text) in order."""
    out = []
    for k, (i, t) in enumerate(rows):
        t, n = t or "", rows[(k + 1) % len(rows)][1] or ""
        e = Q.edited_text(t, n)
        sets = [slow_chunks(x.encode()) for x in (t, e, n)]
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), slow_text(sets[0]), slow_text(sets[1]),
                    slow_likeness(sets[0], sets[1]), slow_likeness(sets[0], sets[2])))
    return out


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.001"
    got = sorted(map(tuple, Q.op2_chunks(spark, d).collect()))
    rows = sorted((r["doc_id"], r["text"]) for r in Q.documents(spark, d).collect())
    assert got == sorted(brute(rows))
    big = [r for r in got if r[1] > 2000]
    assert sum(r[5] for r in big) / len(big) > 0.55
    assert sum(len(r[3]) for r in got) < 0.7 * sum(len((t or "").encode()) for _, t in rows)


def test_edited_chunks_go_on_from_the_kept_ones():
    rng = random.Random(1)
    texts = ["".join(rng.choice("abcé \n") for _ in range(n)).encode() for n in (0, 1, 3, 5, 7, 48, 49, 100, 1000, 5000)]
    for kept_share in (0, 0.3, 0.75, 1):
        kept = [int(len(t) * kept_share) for t in texts]
        edited = [t[:k] + rng.randbytes(rng.randrange(60)) for t, k in zip(texts, kept)]
        got = K.edited_sets(K.chunked(texts), kept, edited)
        assert [g.tolist() for g in got] == [w.tolist() for w in K.chunk_sets(edited)]
        assert all(K.parse(K.as_text(g)).tolist() == g.tolist() for g in got)


def test_odd_rows(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abcde \n") for _ in range(30000))
    rows = [(None, "null id"), (None, None), (5, ""), (5, "tie"), (5, "tie"), (-3, "é" * 700), (9, long),
            (12, "x" + long[:-7]), (40, "zz" * 5000)]
    docs = spark.createDataFrame([(*r, "e") for r in rows], "doc_id long, text string, fingerprint string")
    fields = Q.op2_chunks.__wrapped__ if hasattr(Q.op2_chunks, "__wrapped__") else None
    from pyspark.sql.types import DoubleType, LongType, StringType, StructField
    fields = [StructField("n", LongType()), StructField("e", StringType()), StructField("f", StringType()),
              StructField("g", StringType()), StructField("x", DoubleType()), StructField("y", DoubleType())]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] or "")
    got = successors.map_successive(docs, fields, Q._fingerprint_pairs).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute(sorted(rows, key=key))))
    assert successors.map_successive(docs.limit(0), fields, Q._fingerprint_pairs).count() == 0
    one = successors.map_successive(docs.where("doc_id = 40"), fields, Q._fingerprint_pairs).collect()
    assert one[0]["y"] == 1.0
    f = {r["doc_id"]: r["fingerprint"] for r in K.fingerprints(docs.where("doc_id > 5")).collect()}
    assert K.likeness(K.parse(f[9]), K.parse(f[12])) > 0.95      # shifted by one byte
    assert K.fingerprints(docs).columns == ["doc_id", "text", "fingerprint"]


def test_short_texts_are_near_their_edited_text(spark):
    rows = sorted((r["doc_id"], r["text"] or "") for r in Q.documents(spark, "/root/testdata/sf0.01").collect())
    texts = [t for _, t in rows]
    nexts = texts[1:] + texts[:1]
    sets = [K.chunk_sets([t.encode() for t in x]) for x in (texts, list(map(Q.edited_text, texts, nexts)), nexts)]
    for low, high, least in ((32, 128, 0.5), (128, 256, 0.65), (256, 512, 0.65)):
        at = [k for k, t in enumerate(texts) if low <= len(t) < high and t != nexts[k]]
        edited, following = ([K.likeness(sets[0][k], s[k]) for k in at] for s in sets[1:])
        assert len(at) >= 8 and sum(edited) / len(at) > least
        assert sum(following) / len(at) < 0.1
        assert sum(a > b for a, b in zip(edited, following)) >= 0.95 * len(at)
