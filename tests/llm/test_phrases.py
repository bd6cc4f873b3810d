"""Phrases by groups of suffixes, against brute force over all phrases."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipwell.llm import phrases, spans

SCHEMA = "doc_id long, text string, lang string, n string, phrase string, part string, words string"


def brute(rows, least, longest=5, cover=100, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    out = defaultdict(list)
    for (lang, *w), a in cand.items():
        inside = lambda long: any(list(long[i : i + len(w)]) == w for i in range(1, len(long) - len(w) + 1))
        if any(long[0] == lang and len(long) - 1 > len(w) and inside(long) and 100 * b >= cover * a for long, b in cand.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, *w[:k]] * f[lang, *w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(w).encode(), f[lang, *w[:k]], f[lang, *w[k:]]))
    return sorted(
        (lang, r, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)
    )


def sample(seed):
    rng = random.Random(seed)
    words = ["a", "B", "b", "ab", "é", "a\x00", "\x01", "\x00b", "a\x01\x02", "日本", "ÀB", "\x02", "a\x7f"]
    rows = []
    for _ in range(120):
        bits = rng.choices(words, [9, 5, 4, 3, 2, 1, 1, 1, 1, 1, 1, 1, 1], k=rng.randint(0, 30))
        seps = rng.choices([" ", "\t", "  ", ". ", "\n", ",", "\r", "\x0b"], [20, 2, 1, 1, 1, 1, 1, 1], k=len(bits))
        rows.append(("".join(map("".join, zip(bits, seps))), rng.choice(["en", "de", None, "und", ""])))
    return rows + [("x y z x y z", "en")] * 20 + [(None, "en"), ("", None), (" \n.", "de")]


@pytest.mark.parametrize("seed,least,budget,cover", [(1, 3, 1_000_000, 100), (2, 5, 7, 100), (3, 4, 1, 60), (5, 6, 20, 100)])
def test_collocations_equal_brute_force(spark, seed, least, budget, cover):
    """With one group, with extended prefixes, and with a budget that every prefix passes."""
    rows = sample(seed)
    df = spark.createDataFrame([(i, t, x, *"wxyz") for i, (t, x) in enumerate(rows)], SCHEMA)
    got = phrases.collocations(df, least=least, budget=budget, cover=cover, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, least, cover=cover, top=25)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 30


def test_products_beyond_64_bits(spark):
    counts = spark.createDataFrame([(4_000_000_000_000, 9_000_000_000_000, 5_000_000_000, 3_000_000_007)], "a long, n long, l long, r long")
    a, n, x, y = counts.first()
    exact = lambda c: F.col(c).cast("decimal(19,0)")
    over = (F.lit(1000).cast("decimal(4,0)") * exact("a")).cast("decimal(19,0)") * exact("n")
    got = counts.withColumns({"over": over, "under": exact("l") * exact("r")}).selectExpr("over div under AS s").first().s
    assert got == 1000 * a * n // (x * y)


def test_a_wrong_yes_of_the_bitmap_changes_nothing(spark, monkeypatch):
    rows = sample(4)
    df = spark.createDataFrame([(i, t, x, *"wxyz") for i, (t, x) in enumerate(rows)], SCHEMA)
    want = sorted(map(tuple, phrases.collocations(df, least=4).collect()))
    monkeypatch.setattr(phrases, "bitmap", lambda hashes, shift, bits: b"\xff" * (1 << bits - 3))
    assert sorted(map(tuple, phrases.collocations(df, least=4).collect())) == want == brute(rows, 4)


def test_chunks_of_any_size_and_equal_hashes(monkeypatch):
    """Cuts inside pieces count every suffix once; words of equal hash stay apart."""

    def leaves(size, mix):
        monkeypatch.setattr(phrases, "_CHUNK", size)
        monkeypatch.setattr(phrases, "mixed", mix)
        monkeypatch.setattr(spans, "mixed", mix)
        out, all_ = Counter(), b"\xff" * (1 << phrases.PREFIX_BITS - 3)
        for text, _ in sample(6):
            for data, limit in phrases._cut((text or "").encode(), 4):
                c = phrases.Chunk("en", data, limit)
                _, reach = c.reach([all_] * 3, 5)
                out.update("".join(c.name(x) for x in c.code[i : i + n + 1].tolist()) for i, n in enumerate(reach.tolist()) if n)
                out.update(c.name(x) for x in c.code[: c.own].tolist())
        return out

    mix = spans.mixed
    want = leaves(1 << 21, mix)
    assert leaves(1, mix) == leaves(7, mix) == want == leaves(1 << 21, lambda x: x & np.uint64(3))
    long = "x" * 70
    c = phrases.Chunk("en", f"{long} {long}y {long} {'z' * 9} {long}".encode(), 10**6)
    assert [c.name(x)[:-1] for x in c.code.tolist()] == [long, long + "y", long, "z" * 9, long] and c.code[0] == c.code[2]


def test_edge_rows(edge, nothing):
    got = phrases.collocations(edge, least=2, top=1_000_000).collect()
    by_phrase = {r.phrase: r.a for r in got}
    assert {r.lang for r in got} == {"en"} and all(r.a >= 2 for r in got)
    assert by_phrase["w0x0 w0x1 w0x2 w0x3 w0x4"] == 4  # four copies, each line one chain of equal counts
    assert phrases.collocations(nothing).count() == 0
