import hashlib
import random

import pytest
import public_tokenizers
from tokenizers import Tokenizer

from candlewick.llm import bpe, common as C, lexicon, queries as Q

ODD = [None, "", " ", "a", "\n\n \t x  y ", "<|endoftext|>", "a<|endoftext|> b", "é" * 300, "x" * 5000,
       "don't we'll I'd 12 34½ ²", "\x1c\x1d a\x85b c d", "日本語テキスト", "😀😀 ok", "ſ K",
       "a" * 41 + "bc" * 50, "́̀x", "The the THE", "a  b", "a \nb", "foo\n \tbar x", "a b ", " a", "x\n y\n\n z",
       "end ", " ", "a\u3000 b \u3000c", "it 's 'll"]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_query_matches_library(spark, reference):
    d = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in Q.op1_bpe(spark, d).collect()}
    for r in Q.documents(spark, d).collect():
        ids = reference.encode(r["text"] or "", add_special_tokens=False).ids
        text = reference.decode(ids, skip_special_tokens=False)
        x = got[r["doc_id"]]
        assert x["n_tokens"] == len(ids)
        assert x["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_texts_ties_and_extra_columns(spark, reference):
    rng = random.Random(1)
    texts = ODD + ["".join(rng.choice(" \n'stdé1½.,ab　​漢<|>") for _ in range(80)) for _ in range(60)]
    docs = spark.createDataFrame([(i // 2, t, "x", None) for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, extra string")
    vocab = Q.byte_vocabulary()
    out = bpe.encode(docs, vocab, bpe.build_lexicon(docs, vocab, max_words=40), decoded_col="decoded")
    assert out.columns == ["doc_id", "text", "extra", "ids", "decoded"]
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r["ids"] == reference.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["decoded"] == reference.decode(r["ids"], skip_special_tokens=False) == (r["text"] or "")
    again = bpe.decode(out.select("ids"), vocab).collect()
    assert sorted(r["decoded"] for r in again) == sorted(r["decoded"] for r in rows)


def test_both_patterns_agree():
    import re
    import regex
    rng = random.Random(2)
    near, wide = re.compile(bpe.near_pattern()).findall, regex.compile(bpe.PIECES).findall
    for _ in range(400):
        t = "".join(chr(rng.choice([rng.randrange(bpe.NEAR), rng.randrange(48), 32, 39, 115])) for _ in range(60))
        assert near(t) == wide(t)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    vocab = Q.byte_vocabulary()
    assert bpe.encode(docs, vocab, bpe.build_lexicon(docs, vocab)).count() == 0


def test_lexicon_is_minimal_and_exact(tmp_path):
    words = {w.encode(): [k, k + 1][: 1 + k % 2] for k, w in enumerate(
        a + b for a in ("re", "un", "o", "") for b in ("tion", "ing", "ed", "tions", ""))}
    path = tmp_path / "lex"
    path.write_bytes(lexicon.compile_lexicon(words))
    lex = lexicon.Lexicon(str(path))
    asked = [*words, b"t", b"retio", b"zzz", b"untionss", b"x" * 99]
    found = lex.find(asked)
    for w, rank in zip(asked, found):
        assert (lex.ids_of(rank).tolist() if rank >= 0 else None) == words.get(w)
    # the four prefixes share one set of suffix states
    assert len(lex.accept) < 2 + sum(map(len, ("tions", "ing", "ed", "re", "un", "o")))
