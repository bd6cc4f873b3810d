"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns: the results that the docstrings name."""

import hashlib
import zlib

from pyspark.sql import functions as F

from clipwell.llm import chat, decontamination, line_chunks, line_quality, mixing, near_copies, personal_data, sharding, simhash, token_files, toxicity
from tests.llm.conftest import EDGE

import public_tokenizers

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def key(r):
    return (r is None, r)


def ids(df):
    return sorted((r[0] for r in df.select("doc_id").collect()), key=key)


ALL = sorted((i for i, _, _ in EDGE), key=key)


def test_toxicity(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 0), (1, 0), (6, 1), (7, None), (99, 1), (None, 1)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(edge, labels, 10)
    assert sample.count() == 2
    model = toxicity.fit(sample, min_docs=1)
    scores = toxicity.scored(edge, model)
    assert ids(scores) == ALL and all(0 <= r.score <= 1 for r in scores.collect())
    assert toxicity.scored(nothing, model).count() == 0
    nobody = toxicity.fit(toxicity.labelled_sample(edge, labels.limit(0), 10))
    assert {r.score for r in toxicity.scored(edge, nobody).collect()} == {0.5}


def test_sharding(edge, nothing):
    places = sharding.shard_places(edge, 4).collect()
    assert sorted((r.doc_id for r in places), key=key) == ALL
    for s in {r.shard for r in places}:
        slots = sorted(r.slot for r in places if r.shard == s)
        assert slots == list(range(len(slots)))
    assert {r.text_crc32 for r in places if r.doc_id == 3} == {0} and {r["size"] for r in places if r.doc_id == 3} == {8}
    wide = sharding.sharded(edge, 4)
    assert wide.columns == [c for c in edge.columns if c not in sharding.ADDED] + list(sharding.ADDED)
    pick = ["doc_id", "shard", "slot"]
    assert sorted(map(str, wide.select(*pick).collect())) == sorted(str(r) for r in sharding.shard_places(edge, 4).select(*pick).collect())
    assert sharding.shard_places(nothing, 4).count() == 0 and sharding.sharded(nothing, 4).count() == 0


def test_mixing(edge, nothing):
    mix = mixing.mixed(edge).collect()
    assert sorted((r.doc_id for r in mix), key=key) == ALL
    assert all(r.taken == r.copies * r["size"] <= 3 * r["size"] for r in mix)
    assert {r.taken for r in mix if r.doc_id in (3, 4, 5, 9)} == {0}
    rows = mixing.mixed_rows(edge)
    assert rows.columns == edge.columns
    assert rows.count() == sum(r.copies for r in mix)
    assert mixing.mixed(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0


def test_simhash(edge, nothing):
    found = simhash.near_duplicates(edge).collect()
    assert sorted((r.doc_id for r in found), key=key) == ALL
    of = {r.doc_id: r for r in found}
    assert {of[i].fingerprint for i in (3, 4, 5, 9)} == {"0" * 16} and {of[i].component_id for i in (3, 4, 5, 9)} == {3}
    assert of[1].component_id == of[2].component_id == 1 and of[6].component_id == of[7].component_id == 6
    kept = simhash.one_of_each(edge)
    assert kept.columns == edge.columns
    assert ids(kept) == sorted([1, 3, None, 6, 8, 2**60 + 1], key=key)
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.one_of_each(nothing).count() == 0


def test_near_copies(edge, nothing):
    found = near_copies.near_copies(edge).collect()
    of = {r.doc_id: r.component_id for r in found}
    assert sorted((r.doc_id for r in found), key=key) == ALL
    assert of[1] == of[2] == 1 and of[6] == of[7] == 6 and of[3] == of[4] == of[5] == of[9] == 3 and of[8] == 8
    kept = near_copies.one_of_each(edge)
    assert kept.columns == edge.columns and ids(kept) == sorted([1, 3, None, 6, 8, 2**60 + 1], key=key)
    assert near_copies.near_copies(nothing).count() == 0 and near_copies.one_of_each(nothing).count() == 0


def test_chat(spark):
    schema = "conv_id long, turn int, role string, text string, part string, loss string, n_turns string"
    tail = ("x", "y", "z")
    rows = [
        (1, 1, "assistant", None, *tail), (1, 0, "user", "</turn>\n### a: b\\", *tail), (1, 1, "assistant", "é" * 50, *tail), (None, 0, None, "t", *tail),
        (None, None, "system", "first", *tail), (2, 0, "ro:le\\\n", "### x", *tail), (3, 0, "assistant", "long " * 500_000, *tail), (3, 0, "assistant", "long " * 500_000, *tail),
    ]
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(spark.createDataFrame(rows, schema))).collect()}
    turns = {
        1: [("user", "</turn>\n### a: b\\"), ("assistant", ""), ("assistant", "é" * 50)],
        None: [("system", "first"), ("", "t")],
        2: [("ro:le\\\n", "### x")],
        3: [("assistant", "long " * 500_000)] * 2,
    }
    assert got.keys() == turns.keys()
    for c, t in turns.items():
        loss = "".join(x for r, x in t if r == "assistant")
        assert got[c].n_turns == len(t) and got[c].loss_chars == len(loss)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.read_back(chat.formatted(spark.createDataFrame([], schema))).count() == 0


def test_personal_data(edge, nothing):
    found = personal_data.personal_data(edge)
    assert ids(found) == ALL and personal_data.personal_data(nothing).count() == 0
    assert {len(r.spans) for r in found.collect()} == {0}
    assert personal_data.masked(nothing).count() == 0


def test_token_files(spark, edge, nothing, tmp_path):
    for df, name in ((edge, "edge"), (nothing, "none")):
        token_files.write_tokens(df, f"file://{tmp_path}/{name}", TOKENIZER)
    index = sorted(token_files.token_index(spark, f"file://{tmp_path}/edge").collect(), key=lambda r: r.start)
    assert [r.doc_id for r in index] == sorted((i for i, _, _ in EDGE), key=lambda i: (i is not None, i))
    at = 0
    for r in index:
        assert r.start == at
        at += r.n_tokens
    end = zlib.crc32((2).to_bytes(4, "little"))
    assert {(r.n_tokens, r.ids_crc32) for r in index if r.doc_id in (3, 4)} == {(1, end)}
    assert token_files.token_index(spark, f"file://{tmp_path}/none").count() == 0


def test_line_quality(edge, nothing):
    got = line_quality.line_verdicts(edge).collect()
    assert sorted((r.doc_id for r in got), key=key) == ALL
    of = {r.doc_id: r for r in got}
    assert not of[3].kept and of[3].n_words == 0 and of[1].kept and of[2].kept
    kept = line_quality.accepted(edge)
    assert kept.columns == edge.columns and kept.count() == sum(r.kept for r in got)
    assert line_quality.accepted(edge, strip=True).where("doc_id = 1").first().text == EDGE[0][1]
    assert line_quality.line_verdicts(nothing).count() == 0 and line_quality.accepted(nothing).count() == 0


def test_line_chunks(edge, nothing):
    gone = line_chunks.repeated_chunks(edge)
    # the null id comes first and holds the text's only kept copy; the long texts differ in their one line
    assert {r.doc_id for r in gone.select("doc_id").collect()} == {1, 2}
    assert {r.first_doc_id for r in gone.collect()} == {None}
    cut = line_chunks.without_repeats(edge)
    assert cut.columns == edge.columns and cut.count() == edge.count()
    assert cut.where("doc_id = 6").first().text == EDGE[8][1] and cut.where("doc_id = 3").first().text is None
    assert line_chunks.repeated_chunks(nothing).count() == 0 and line_chunks.without_repeats(nothing).count() == 0


def test_decontamination(spark, edge, nothing):
    items = spark.createDataFrame([(7, EDGE[0][1][:100], "x"), (None, None, "x"), (8, "", "x"), (9, "one two", "x")], "item_id long, text string, row_key string")
    found = decontamination.contaminated(edge, items).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 7), ("2", 7), ("2", 7), ("None", 7)]
    left = decontamination.clean(edge, items)
    assert left.columns == edge.columns and left.count() == edge.count() - 4
    assert decontamination.contaminated(nothing, items).count() == 0
    assert decontamination.contaminated(edge, items.limit(0)).count() == 0
    assert decontamination.clean(edge, items.limit(0)).count() == edge.count()


def test_no_operator_reads_by_position(edge):
    """Other column orders give the same results."""
    turned = edge.select(*reversed(edge.columns))
    assert sorted(map(str, simhash.near_duplicates(turned).select("doc_id", "component_id").collect())) == sorted(
        map(str, simhash.near_duplicates(edge).select("doc_id", "component_id").collect())
    )
    assert turned.select(F.max("doc_id")).first()[0] == 2**60 + 1
