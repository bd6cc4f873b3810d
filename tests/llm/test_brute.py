"""Operators that SQL cannot express, against brute force on whole small tables or on random cases."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from clipwell.llm import chat, decontamination, graph, near_copies, personal_data, sharding, simhash, token_files, toxicity
from clipwell.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


def components_of(adjacent):
    label = np.arange(len(adjacent))
    while True:
        least = np.array([label[row].min() for row in adjacent])
        if (least == label).all():
            return label
        label = least


def near(prints, radius=2):
    p = np.array(prints, np.uint64)
    return np.bitwise_count(p[:, None] ^ p[None, :]) <= radius


def naive_fingerprint(text):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_trees_find_every_link():
    rng = random.Random(1)
    for _ in range(15):
        prints = set()
        for _ in range(30):
            base = rng.getrandbits(64)
            for _ in range(rng.randint(1, 40)):
                x = base
                for _ in range(rng.randint(0, 5)):
                    x ^= 1 << rng.randrange(64)
                prints.add(x)
        rows = sorted((rng.randrange(3), x) for x in prints)
        buckets, p = np.array([b for b, _ in rows]), np.array([x for _, x in rows], np.uint64)
        want = components_of(near(p) & (buckets[:, None] == buckets[None, :]))
        assert (simhash.local_roots(buckets, p, 2) == want).all()


@pytest.mark.parametrize("most", [4096, 3])
def test_links_of_a_dense_set(spark, monkeypatch, most):
    """Also with buckets that are keyed again."""
    monkeypatch.setattr(simhash, "MAX_TREE", most)
    rng, prints = random.Random(2), set()
    for _ in range(25):
        base = rng.getrandbits(64)
        prints.add(base)
        for _ in range(20):
            x = base
            for _ in range(rng.randint(1, 4)):
                x ^= 1 << rng.randrange(64)
            prints.add(x)
    prints = sorted(prints)
    signed = [int(x) for x in np.array(prints, np.uint64).view(np.int64)]
    found = graph.components(simhash.linked(spark.createDataFrame([(x,) for x in signed], "fp long"))).collect()
    root = {r.node: r.root for r in found}
    groups, want = defaultdict(set), defaultdict(set)
    for s, w in zip(signed, components_of(near(prints))):
        groups[root.get(s, s)].add(s)
        want[w].add(s)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_components_of_chains_and_stars(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, j) for j in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    adjacent = np.eye(300, dtype=bool)
    for a, b in edges:
        adjacent[a, b] = adjacent[b, a] = True
    want = {i: int(w) for i, w in enumerate(components_of(adjacent)) if w != i}
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {k: v for k, v in got.items() if k != v} == want


def test_op4(spark, documents):
    rows = sorted((r.doc_id, naive_fingerprint(r.text)) for r in documents.collect())
    label = components_of(near([p for _, p in rows]))
    want = {i: (f"{p:016x}", rows[w][0]) for (i, p), w in zip(rows, label)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash_components"](spark, FOLDER).collect()}
    assert got == want


def naive_spans(t):
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, t):
            d = re.sub("[^0-9]", "", m[0])
            total = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
            if kind == "ip" and max(map(int, m[0].split("."))) > 255 or kind == "card" and (not 16 <= len(d) <= 19 or total % 10):
                continue
            if kind == "phone" and not 8 <= len(d) <= 15:
                continue
            yield kind, *m.span()


def test_base_spans_on_random_texts():
    rng = random.Random(4)
    bits = [*"aZ09@@..+-- ()%_", "1.2.3.4", "4111 1111 1111 1111", "4111111111111111", "a@b.c", "+1 (383) 555-6083", "é", "25", "0"]
    for _ in range(20_000):
        t = "".join(rng.choices(bits, k=rng.randint(0, 25)))
        assert [x[:3] for x in personal_data.spans_of(t) if x[0] in personal_data.BASE] == list(naive_spans(t)), t


def test_op6(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op6_personal_data"](spark, FOLDER).collect()}
    for r in documents.collect():
        base = list(naive_spans(r.text))
        joined = ",".join("%s:%d:%d" % x for x in base)
        assert got[r.doc_id].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert got[r.doc_id].n_phone == sum(x[0] == "phone" for x in base)
        assert set(filter(None, joined.split(","))) <= set(got[r.doc_id].spans.split(","))


def test_checksums_and_context():
    iban = "DE89 3704 0044 0532 0130 00"
    found = personal_data.spans_of(f"pay to {iban} AND more, GB82 WEST 1234 5698 7654 33 is wrong")
    assert [x[:3] for x in found] == [("iban", 7, 7 + len(iban))]
    assert [x[0] for x in personal_data.spans_of("ssn 123-45-6789")] == ["ssn"] and not personal_data.spans_of("part 123-45-6789")
    assert [x[0] for x in personal_data.spans_of("amex 378282246310005")] == ["short_card"]
    assert not personal_data.spans_of("order 378282246310005") and not personal_data.spans_of("amex 378282246310006")
    (plain,), (near_word,) = personal_data.spans_of("x 1.2.3.4"), personal_data.spans_of("server 1.2.3.4")
    assert near_word[3] > plain[3]


def test_long_hostile_texts_take_linear_time():
    for t in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1" * 150_000, "1 " * 150_000, "a@" * 150_000, "A1" * 150_000):
        personal_data.spans_of(t)


def test_masked(spark):
    df = spark.createDataFrame([(1, "mail a@b.de or 1.2.3.4 now")], "doc_id long, text string")
    assert personal_data.masked(df).first().text == "mail [email] or [ip] now"


def test_encoder_equals_whole_texts():
    rng = random.Random(5)
    encoder = token_files.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.by_parts
    bits = ["a", "bc", "é", " ", "  ", "\n", "\n\n", "\t", "\r", " ", "'s", "'", "12", "!", "?!", "\x1c", "　", "<|endoftext|>", "日本", "​", "\x85"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 12))) for _ in range(20_000)]
    for at in range(0, len(texts), 500):
        own = texts[at : at + 500]
        sizes, ids = encoder.encode([t.encode() for t in own])
        want = encoder._ids(own)
        assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == np.concatenate(want).tolist()
    assert [x.tolist() for x in encoder.encode([b"", b""])] == [[0, 0], []]


def test_op7(spark, documents):
    from tokenizers import Tokenizer

    model, at, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in sorted(documents.collect(), key=lambda r: r.doc_id):
        ids = [*model.encode(r.text, add_special_tokens=False).ids, 2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, QUERIES["op7_token_files"](spark, FOLDER).collect())) == want


def test_files_hold_ascending_ids(spark, tmp_path):
    """Files by name, and the rows of each file, follow the ids; stripes have Bloom filters on them."""
    import glob

    from pyarrow import orc

    rows = [(i * 7919 % 5000, f"text {i}") for i in range(5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_tokens(df, f"file://{tmp_path}/t", public_tokenizers.path("byte_bpe_50k.json"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [orc.ORCFile(f) for f in sorted(glob.glob(f"{tmp_path}/t/*.orc"))]
    ids = [x for f in files for x in f.read(["doc_id"]).column("doc_id").to_pylist()]
    assert ids == sorted(ids) == list(range(5000)) and len(files) > 1
    index = sorted(token_files.token_index(spark, f"file://{tmp_path}/t").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in index] == ids


def test_lookup_reads_by_metadata(spark, documents, tmp_path):
    folder = f"file://{tmp_path}/t"
    token_files.write_tokens(documents, folder, public_tokenizers.path("byte_bpe_50k.json"))
    found = token_files.lookup(spark, folder, [5, 17])
    assert sorted(r.doc_id for r in found.collect()) == [5, 17]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    assert "PushedFilters: [In(doc_id, [" in found._jdf.queryExecution().explainString(mode)


def test_rendered_turns_parse_to_their_source():
    rng = random.Random(6)
    bits = ["\\", "</turn>", "### ", "#", "\n", "a", ": ", "ok", "\\n", "</turn", "é", "<", "/turn>", "\\### "]
    for _ in range(20_000):
        turns = [("".join(rng.choices(bits, k=rng.randint(0, 4))), "".join(rng.choices(bits, k=rng.randint(0, 9)))) for _ in range(3)]
        out = [chat.render(*t) for t in turns]
        assert [x[:2] for x in chat.parse("".join(o for o, _, _ in out))] == turns
        assert [chat.unescaped(o[s:e]) for o, s, e in out] == [t for _, t in turns]
    assert chat.parse("### user: a\n### b</turn>\n") is None and chat.parse("### user: a") is None


def test_op5(spark):
    turns = defaultdict(list)
    for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").collect():
        turns[r.conv_id].append((r.turn, r.role, r.text))
    turns[-7] = [(0, "user", "\\### Assistant: </turn> ok"), (1, "assistant", "\\### Assistant: </turn> ok")]
    got = {r.conv_id: r for r in QUERIES["op5_chat_format"](spark, FOLDER).collect()}
    assert got.keys() == turns.keys()
    for c, t in turns.items():
        t.sort()
        loss = "".join(x for _, r, x in t if r == "assistant")
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in t).encode()).hexdigest()
        assert (got[c].n_turns, got[c].loss_chars, got[c].loss_sha256) == (len(t), len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_parts_of_a_long_conversation(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"</turn> {i} " + "x" * (i % 50)) for i in range(3000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    whole = chat.read_back(chat.formatted(turns)).first()
    parts = chat.formatted(turns, part_chars=1000)
    assert parts.count() > 50 and chat.read_back(parts).first() == whole


def test_op2(spark, documents):
    rows = sorted((hashlib.md5(r.text.encode()).digest(), r.doc_id, len(r.text.encode()) + 8) for r in documents.collect())
    got = QUERIES["op2_byte_shards"](spark, FOLDER).collect()
    total, largest = sum(r[2] for r in rows), max(r[2] for r in rows)
    of = {r.doc_id: r for r in got}
    order = [(of[i].shard, of[i].slot) for _, i, _ in rows]
    assert order == sorted(order) and len(of) == len(rows)
    sizes = defaultdict(int)
    for _, i, n in rows:
        assert of[i]["size"] == n
        sizes[of[i].shard] += n
    assert all(abs(x - total / 24) <= max(largest, 0.05 * total / 24) for x in sizes.values())
    text = {r.doc_id: r.text for r in documents.collect()}
    assert all(r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)


def test_small_groups_share_a_shard_and_large_ones_do_not_unbalance(spark):
    rows = [(i, f"text {i // 3} " + "y" * 90) for i in range(3000)] + [(10_000 + i, "copy " * 20) for i in range(1500)]
    got = sharding.shard_places(spark.createDataFrame(rows, "doc_id long, text string"), 10).collect()
    shards = defaultdict(set)
    for r in got:
        if r.doc_id < 10_000:
            shards[r.doc_id // 3].add(r.shard)
    assert all(len(s) == 1 for s in shards.values())
    sizes = defaultdict(int)
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) <= 1.1 * min(sizes.values()) and len(sizes) == 10


def naive_overlaps(text, items):
    """Items of which a segment of some alignment with the text meets the two bounds, without seeds."""
    ws = decontamination.tokens(text)
    for item_id, item in items:
        own = decontamination.tokens(item)
        need = min(10, max(6, -(-len(own) * 4 // 5)))

        def hit(shift):
            total = np.concatenate(([0], np.cumsum([0 <= shift + i < len(ws) and ws[shift + i] == w for i, w in enumerate(own)])))
            return any(total[b] - total[a] >= need and 5 * (total[b] - total[a]) >= 4 * (b - a) for a in range(len(own)) for b in range(a + need, len(own) + 1))

        if any(map(hit, range(-len(own), len(ws)))):
            yield item_id


def test_seeds_miss_no_overlap(spark):
    rng = random.Random(7)
    word = lambda: f"w{rng.randrange(400)}"
    items = [(i, " ".join(word() for _ in range(rng.randint(8, 30)))) for i in range(12)]
    docs = []
    for i in range(150):
        body = [word() for _ in range(40)]
        if i % 3 == 0:
            own = rng.choice(items)[1].split()
            own[rng.randrange(len(own))] = "changed"
            if i % 2:
                own = [x.upper() + "," for x in own]
            body[10:10] = own
        docs.append((i, " ".join(body)))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), block_tokens=80
    ).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, k) for i, t in docs for k in naive_overlaps(t, items)}


def test_masks_hit_every_two_substitutions_in_thirteen_tokens():
    for a in range(13):
        for b in range(a):
            assert any(
                all(at + i not in (a, b) for i, c in enumerate(mask) if c == "1") for mask in decontamination.MASKS for at in range(13 - len(mask) + 1)
            )


def test_op1_held_out(spark):
    folder = "/root/testdata/sf0.1"
    scores = QUERIES["op1_toxicity_scores"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r for r in scores if r.toxic == 1]
    clean = [r for r in scores if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.005 * len(clean)


def test_features_of_pieces_equal_the_whole(monkeypatch):
    text = "Some text, ABC abc. " * 40
    lookup = toxicity.Lookup(toxicity.present(text)[::3])
    want = [x.tolist() for x in lookup.features(text)]
    monkeypatch.setattr(toxicity, "_PIECE", 7)
    assert [x.tolist() for x in lookup.features(text)] == want


def similar_pairs(text):
    """(pairs of ids with five-word Jaccard of 0.8 or more, ids with no other text of 0.6 or more nor an equal fingerprint within 2 bits)."""
    ids = sorted(text)
    sets = {}
    for i in ids:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text[i] or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    holders = defaultdict(list)
    for i in ids:
        for x in sets[i]:
            holders[x].append(i)
    common = defaultdict(int)
    for held in holders.values():
        for a in held:
            for b in held:
                if a < b:
                    common[a, b] += 1
    sim = {p: n / (len(sets[p[0]]) + len(sets[p[1]]) - n) for p, n in common.items()}
    close = {x for p, s in sim.items() if s >= 0.6 for x in p}
    return [p for p, s in sim.items() if s >= 0.8], set(ids) - close


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_near_copies_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = near_copies.near_copies(docs).collect()
    group = {r.doc_id: r.component_id for r in rows}
    text = {r.doc_id: r.text for r in docs.collect()}
    pairs, clean = similar_pairs(text)
    different = [p for p in pairs if text[p[0]] != text[p[1]]]
    found = sum(group[a] == group[b] for a, b in different)
    assert len(different) and found >= 0.9 * len(different), (found, len(different))
    alone = {i for i in clean if (text[i] or "").strip()}
    assert all(group[i] == i for i in alone) and len(alone) > 50


def test_sketch_agrees_with_sets():
    rng = random.Random(9)
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(rng.choices(words, k=2000))
    other = base.split()
    for i in range(0, 2000, 60):
        other[i] = "x"
    a, b = base.encode(), " ".join(other).encode()
    exact = near_copies.jaccard(a, b, 5)
    x, y = (set(zip(*[t.decode().split()[k:] for k in range(5)])) for t in (a, b))
    assert exact == len(x & y) / len(x | y)
    agree = (near_copies.sketch(a, 5)[1] == near_copies.sketch(b, 5)[1]).mean()
    assert abs(agree - exact) < 0.2 and near_copies.sketch(a, 3)[0] & (2**64 - 1) == simhash.fingerprint(a, 3)
    assert near_copies.jaccard(b"", b" ", 5) == 1.0 and near_copies.jaccard(b"A b", b"a  B", 5) == 1.0 and near_copies.jaccard(b"a", b"", 5) == 0.0


def test_pipeline_stages(spark, documents):
    """Each stage on its own input: rows are kept whole, and only for the stage's reason."""
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:3]:
        left = stage(spark, docs, FOLDER).cache()
        assert left.columns == documents.columns
        assert left.join(docs, documents.columns, "left_semi").count() == left.count() == left.select("doc_id").distinct().count()
        gone = {r.doc_id: r.text for r in docs.join(left, "doc_id", "left_anti").collect()}
        stay = {r.doc_id: r.text for r in left.collect()}
        if name == "near_dedup":
            # what goes is linked to something that stays or went; of pairs of 0.8 or more one goes
            text = gone | stay
            near_, clean = similar_pairs(text)
            one_left = [p for p in near_ if not (p[0] in stay and p[1] in stay)]
            assert len(one_left) >= 0.9 * len(near_) and set(gone) <= set(text) - clean
        if name == "decontaminate":
            items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
            assert set(gone) == {i for i, t in (gone | stay).items() if any(x in t for x in items)}
        docs = left
    mix = corpus_pipeline.mix(spark, docs, FOLDER).cache()
    assert mix.columns == documents.columns and mix.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    last = corpus_pipeline.shard(spark, mix, FOLDER)
    assert last.count() == mix.count() and last.select("shard", "slot").distinct().count() == mix.count()
    assert sorted(map(tuple, last.select("doc_id").collect())) == sorted(map(tuple, mix.select("doc_id").collect()))
