"""Whole results: overlaps by their stated bounds, account lists, against brute force."""

import random
from itertools import combinations
from math import ceil

from pyspark.sql import functions as F

from clipwell.llm import decontamination, line_chunks, line_quality, personal_data


def overlaps_by_bounds(ws, own):
    """Most equal tokens of any segment of any alignment that meets the two bounds, without seeds or scores; 0 if none."""
    need, best = min(10, max(6, ceil(0.8 * len(own)))), 0
    for shift in range(-len(own), len(ws)):
        same = [0 <= shift + i < len(ws) and ws[shift + i] == w for i, w in enumerate(own)]
        for a in range(len(own)):
            for b in range(a + need, len(own) + 1):
                hit = sum(same[a:b])
                if hit >= need and 5 * hit >= 4 * (b - a):
                    best = max(best, hit)
    return best


def test_op10_every_arrangement_within_the_bounds_is_an_overlap():
    for n in range(6, 16):
        own = [f"t{i}" for i in range(n)]
        block = decontamination.Block([(1, " ".join(own))])
        for k in range(n // 5 + 1):
            for changed in combinations(range(n), k):
                ws = ["x", *("y" if i in changed else w for i, w in enumerate(own)), "z"]
                want = overlaps_by_bounds(ws, own)
                assert [x[1] for x in block.overlaps(" ".join(ws), 10, 0.8)] == [want] * (want > 0), (n, changed)
                assert want or 5 * (n - k) < 4 * n or n - k < min(10, max(6, ceil(0.8 * n)))


def test_op10_random_items_with_substitutions():
    rng = random.Random(8)
    for _ in range(150):
        own = [f"w{rng.randrange(60)}" for _ in range(rng.randint(5, 28))]
        ws = [f"w{rng.randrange(60)}" for _ in range(12)]
        copy = [f"v{rng.randrange(9)}" if rng.random() < 0.17 else w for w in own]
        ws[6:6] = copy
        want = overlaps_by_bounds(ws, own)
        found = decontamination.Block([(1, " ".join(own))]).overlaps(" ".join(ws), 10, 0.8)
        assert [x[1] for x in found] == [want] * (want > 0)
        for _, hit, other, words, first, end in found:
            assert hit >= 4 * other and hit + other == end - first and words == len(own)


def test_op10_items_of_six_and_seven_tokens():
    assert decontamination.Block([(1, "a b c d e f")]).overlaps("x A b, c d e f y", 10, 0.8) == [(0, 6, 0, 6, 1, 7)]
    for text in ("x b c d e f g", "a b c d e f x"):
        assert [x[1] for x in decontamination.Block([(1, "a b c d e f g")]).overlaps(text, 10, 0.8)] == [6]


def test_op10_blocks_hold_each_text_once_and_keep_their_bound(spark):
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(500)}" for _ in range(rng.randint(8, 60))) for _ in range(80)]
    copies = spark.range(100_000).select(F.col("id").alias("item_id"), F.lit(texts[0]).alias("text"))
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").unionByName(copies)
    blocks = decontamination.blocks_of(items, "text", 400).collect()
    assert sorted(r.t for r in blocks) == sorted(set(texts))
    sizes = {}
    for r in blocks:
        sizes.setdefault(r.block, []).append(len(decontamination.tokens(r.t)))
    assert len(sizes) > 5 and all(sum(x) - max(x) <= 400 for x in sizes.values())
    docs = spark.createDataFrame([(i, f"own words {t} end") for i, t in enumerate(texts)] + [(500, "nothing here")], "doc_id long, text string")
    few = items.where("item_id < 80").unionByName(copies.limit(0))
    one, many = (decontamination.contaminated(docs, few, block_tokens=n) for n in (10**6, 400))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, many.collect()), key=repr)
    assert {(r.doc_id, r.item_id) for r in many.collect()} >= {(i, i) for i in range(80)}
    assert decontamination.clean(docs, items, block_tokens=400).select("doc_id").collect() == [(500,)]
    again = decontamination.contaminated(docs.where("doc_id = 0"), items).groupBy("item_id").count()
    assert again.where("item_id >= 80").count() == 100_000 - 80


def test_op6_every_account_of_a_run():
    de, gb = "DE89370400440532013000", "GB82WEST12345698765432"
    ibans = lambda t: [t[s:e] for k, s, e, _ in personal_data.spans_of(t) if k == "iban"]
    assert ibans(f"{de} {gb}") == [de, gb]
    assert ibans(f"AB12 {de}") == [de] and ibans(f"PAY DE12 TO {de} OR {gb} NOW") == [de, gb]
    assert ibans(f"DE89 3704 0044 0532 0130 00 {gb} DE89 3704") == ["DE89 3704 0044 0532 0130 00", gb]
    assert ibans(f"{de}X {de[:-1]} x{gb}") == []
    assert len(ibans(" ".join([de] * 5000))) == 5000 and not ibans("DE89 " * 60_000)


def lines_seen_before(docs):
    """Lines of runs of two or more lines with 20 words, or one of 50, that an earlier text or place has, edges with words."""
    gone, rows = set(), [(i, t.split("\n")) for i, t in sorted(docs)]
    for d, (i, mine) in enumerate(rows):
        for e, (_, other) in enumerate(rows[: d + 1]):
            for a in range(len(mine)):
                for b in range(len(other)):
                    n = 0
                    while a + n < len(mine) and b + n < len(other) and mine[a + n] == other[b + n] and (e < d or b + n < a):
                        n += 1
                        words = sum(len(x.split()) for x in mine[a : a + n])
                        if n > 1 and words >= 20 or words >= 50:
                            gone |= {(i, x) for x in range(a, a + n)}
    return gone


def passages_in_contexts():
    """Documents that share passages of many shapes between lines of their own."""
    rng, docs = random.Random(9), []
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passages = [[line(30) for _ in range(2)], [line(20) for _ in range(3)], [line(6) for _ in range(12)], [line(15), line(15), line(1)], [line(55)], [line(9), line(9)]]
    passages += [[line(30), ""], [line(12), "", line(12)], [line(1), line(25)]]
    for i in range(60):
        body = []
        for _ in range(rng.randint(1, 3)):
            body += [line(rng.randint(1, 14)) for _ in range(rng.randint(0, 3))] + rng.choice(passages)[rng.randint(0, 1) :]
        docs.append((i, "\n".join(body)))
    docs.append((60, "\n".join(["ten words " * 6] * 5)))
    docs += [(61, "\n" * 40 + passages[0][0] + "\n" * 300), (62, "own\n" + "\n" * 9 + passages[0][0] + "\nother")]
    return docs


def lines_of(found):
    return {(r.doc_id, x) for r in found.collect() for x in range(r.start_line, r.end_line + 1)}


def test_op9_chunks_equal_brute_force(spark):
    docs = passages_in_contexts()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = lines_of(line_chunks.repeated_chunks(df))
    text = {(i, x): v for i, t in docs for x, v in enumerate(t.split("\n"))}
    full = lambda found: {x for x in found if text[x].strip()}
    want = lines_seen_before(docs)
    assert got <= want and full(got) == full(want) and len(want) > 200
    assert got == lines_of(line_chunks.repeated_runs(df))
    left = {r.doc_id: r.text for r in line_chunks.without_repeats(df).collect()}
    assert all(left[i].split("\n") == ([v for x, v in enumerate(t.split("\n")) if (i, x) not in got] or [""]) for i, t in docs)


def test_op9_boundaries_are_few_and_the_same_in_every_copy(spark):
    rng = random.Random(4)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(4))
    shared = [line() for _ in range(400)]
    before = [[line() for _ in range(n)] for n in (0, 3, 17)]
    df = spark.createDataFrame([(i, "\n".join(b + shared)) for i, b in enumerate(before)], "doc_id long, text string")
    keys = {r.row_key: r.doc_id for r in line_chunks.windows(df, "doc_id", "text").collect()}
    places = [set() for _ in before]
    for r in line_chunks.boundaries(df, "doc_id", "text").collect():
        i = keys[r.row_key]
        if r.p >= len(before[i]) + 5:
            places[i].add(r.p - len(before[i]))
    assert places[0] == places[1] == places[2] and 100 < len(places[0]) < 200


def test_op9_lines_of_equal_digests_are_compared(spark, monkeypatch):
    """With digests of one hexadecimal figure, different lines share one: what cannot be told apart stays."""
    docs = passages_in_contexts()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(line_chunks, "_line_digest", lambda x: F.concat(F.lit("0"), F.substring(F.md5(x.cast("binary")), 1, 1)))
    assert lines_of(line_chunks.repeated_chunks(df)) <= lines_seen_before(docs)
    alike = df.where("doc_id in (0, 60)").unionByName(spark.createDataFrame([(99, docs[0][1])], "doc_id long, text string"))
    monkeypatch.undo()
    assert lines_of(line_chunks.repeated_chunks(alike)) >= {(99, x) for x in range(docs[0][1].count("\n") + 1) if docs[0][1].split("\n")[x].strip()}


def test_op8_repeats_are_compared_word_by_word(spark):
    """With hashes cut to 16 bits, so that different windows share one."""
    rng = random.Random(12)
    texts = [[f"w{rng.randrange(10**6)}" if rng.random() < 0.97 else "a" for _ in range(200)] for _ in range(250)]
    texts = [t + t[i : i + 5] * (i % 3) for i, t in enumerate(texts)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, w array<string>")

    def repeated(t):
        seen = {}
        for k in range(len(t) - 2):
            seen.setdefault(tuple(t[k : k + 3]), []).append(k)
        return len({k + j for at in seen.values() if len(at) > 1 for k in at for j in range(3)})

    want = [repeated(t) for t in texts]
    for spare in (0, 40):
        got = {r.i: r.n for r in line_quality._repeat_words(df, "w", "n", spare).select("i", F.col("n")).collect()}
        assert [got[i] for i in range(len(texts))] == want
    assert sum(map(bool, want)) > 100
