import random
import re
from collections import Counter

from candlewick.llm import licenses as L, queries as Q

PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""


def brute(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    hits = [(i, lab) for p, lab in PHRASES.items() for i in range(len(words))
            if words[i:i + len(p.split())] == p.split()]
    return (len(words), len(hits), min((h[0] for h in hits), default=None),
            max((h[0] for h in hits), default=None), ",".join(sorted({h[1] for h in hits})))


def test_query_matches_brute_force(spark):
    d = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in Q.op4_licenses(spark, d).collect()}
    for r in Q.documents(spark, d).collect():
        x = got[r["doc_id"]]
        assert (x["n_words"], x["n_base"], x["first_word"], x["last_word"], x["base_labels"]) == brute(r["text"])
        assert set(filter(None, x["base_labels"].split(","))) <= set(x["labels"].split(","))
        assert 0 <= x["score"] <= 1 and (x["score"] > 0) == (x["labels"] != "")
    assert any(x["labels"] for x in got.values())


def labels(text):
    a = L.TokenAutomaton(L.TEMPLATES)
    return {L.TEMPLATES[k].label for _, _, k in a.matches(L.words_of(text.encode()))}


def test_optional_and_replaceable_regions():
    assert "mit-text" in labels(MIT)
    assert "mit-text" in labels(MIT.replace("the Software is furnished", "the Acme Tools is furnished"))
    assert "mit-text" in labels(MIT.replace("notice shall", "notice (including the next paragraph) shall"))
    assert "mit-text" not in labels(MIT.replace("sublicense", "resell"))       # mandatory wording
    assert "mit-text" not in labels(MIT.replace("the Software is furnished", "a b c d e is furnished"))
    assert labels("GNU Lesser General Public License v 3") == {"gpl", "gpl-named", "gpl-version"}
    a = L.TokenAutomaton((L.Template("x", "a [b [c]] {0-2} d"),))
    for text, ok in (("a d", 1), ("a b d", 1), ("a b c d", 1), ("a x y d", 1), ("a b c x y d", 1),
                     ("a b c x y z d", 0), ("a x", 0), ("b d", 0)):
        assert bool(a.matches(text.encode().split())) == bool(ok), text


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (None, "MIT License" * 3, None), (2, "mit  LICENSE mit license", "y"),
            (2, "mit  LICENSE mit license", "y"), (3, "w " * 60000 + "apache license", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_WORDS string")
    out = L.scan(docs)
    assert out.columns == ["doc_id", "text", "n_words", "license_matches", "license_score"]
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        base = [m for m in r["license_matches"] if m["base"]]
        n, k, first, _, _ = brute(r["text"])
        assert (r["n_words"], len(base)) == (n, k)
        assert min((m["start"] for m in base), default=None) == first
    assert L.scan(docs.limit(0)).count() == 0


def expanded(markup):
    """The template as a regular expression over words that are each followed by one space."""
    out = []
    for token in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", markup):
        least_most = token[1:-1].split("-")
        out.append("(?:" if token == "[" else ")?" if token == "]"
                   else f"(?:\\S+ ){{{least_most[0]},{least_most[1]}}}" if token[0] == "{" else re.escape(token) + " ")
    return re.compile("".join(out))


def test_template_matches_equal_an_expansion_to_regular_expressions():
    rng = random.Random(6)
    patterns = [expanded(t.markup) for t in L.TEMPLATES]
    automaton = L.TokenAutomaton(L.TEMPLATES)
    hits = Counter()
    for trial in range(6 * len(L.TEMPLATES)):
        t = L.TEMPLATES[trial % len(L.TEMPLATES)]
        words = rng.choices(["software", "the", "license", "x1"], k=rng.randrange(3))
        depth, keep = 0, [True]
        for token in re.findall(r"\[|\]|\{\d+-\d+\}|[^\s\[\]{}]+", t.markup):
            if token == "[":
                keep.append(keep[-1] and rng.random() < 0.5)
            elif token == "]":
                keep.pop()
            elif keep[-1]:
                words += (rng.choices(["acme", "the", "software"], k=rng.randint(*map(int, token[1:-1].split("-"))))
                          if token[0] == "{" else [token])
        if trial // len(L.TEMPLATES) % 3 == 2:               # a mandatory word changed: mostly no match
            words[rng.randrange(len(words))] = "changed"
        words += rng.choices(["of", "mit", "2", "0"], k=rng.randrange(3))
        want = set()
        for i in range(len(words)):
            for k, p in enumerate(patterns):
                end = next((j for j in range(len(words), i, -1) if p.fullmatch(" ".join(words[i:j]) + " ")), None)
                if end:
                    want.add((i, end, k))
        assert set(automaton.matches([w.encode() for w in words])) == want
        hits.update(L.TEMPLATES[k].label for _, _, k in want)
    assert {t.label for t in L.TEMPLATES} == set(hits)
