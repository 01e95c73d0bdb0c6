"""Every operator on awkward rows: nulls, empty and long texts, repeats, clashing columns, empty tables."""

from __future__ import annotations

import time

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from chorale.llm import chat, exact, jaccard, langid, mixing, packing, quality, scoring, shards, urls
from chorale.session import materialize

FILES = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")]
SENTENCE = "the quick brown fox jumps over the lazy dog and runs back to its den before night falls on all the hills"
# Columns named as the operators name their own.
EXTRA = "key long, row long, rank long, n long, bucket long, shard int, slot long, block long, print long, class long"
COLUMNS = f"doc_id long, text string, lang string, source string, {EXTRA}"
ROWS = [
    (1, None, "en", "a"),
    (2, "", "en", "a"),
    (3, " \n\t ", None, None),
    (4, "one", "en", None),
    (5, SENTENCE, "en", "b"),
    (5, SENTENCE, "en", "b"),
    (6, SENTENCE.replace(" ", "  \n"), "en", "b"),
    (None, "null key here", None, "b"),
    (7, " ".join(f"w{i % 5000}" for i in range(60_000)), "en", "a"),
    (8, "123 456 !!!", "fr", "a"),
    (9, "été à la forêt où naît l’été", "fr", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, *[0] * 10) for r in ROWS], COLUMNS)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def test_quality(docs, empty):
    rows = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert quality.judge(docs).count() == len(ROWS)
    assert rows[1].n_words == 0 and rows[1].base_failed and not rows[1].kept
    assert rows[7].n_words == 60_000 and rows[7].n_repeat_words == 60_000 and rows[7].base_failed
    assert rows[5].n_words == 22 and rows[5].kept
    assert quality.judge(empty).count() == 0


def test_language(docs, empty):
    model = langid.fit(docs.filter("NOT doc_id <=> 7"))
    rows = {r.key: r for r in langid.predict(docs, model).collect()}
    assert {rows[i].lang_pred for i in (1, 2, 3, 8)} == {"und"} and rows[8].score == 0
    assert rows[5].lang_pred == "en" and rows[9].lang_pred == "fr" and 0 <= rows[9].score <= 1
    assert langid.predict(docs, model).count() == len(ROWS)
    assert langid.identified(docs, model).columns == docs.columns
    assert langid.identified(docs, model).count() == len(ROWS) - 4
    assert langid.predict(empty, langid.fit(empty)).count() == 0
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(empty)).collect()} == {"und"}


def test_scoring(docs, empty):
    rows = scoring.score(docs, scoring.fit(docs)).collect()
    assert len(rows) == len(ROWS)
    by = {r.key: r for r in rows}
    assert by[1].n_tokens == by[2].n_tokens == by[3].n_tokens == 1 and by[7].n_tokens == 60_001
    assert all(r.score < 0 and r.n_known == r.n_tokens for r in rows)
    untrained = scoring.score(docs, scoring.fit(empty)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in untrained)
    assert scoring.score(empty, scoring.fit(empty)).count() == 0


def test_exact(docs, empty):
    rows = exact.duplicates(docs).collect()
    by = {r.key: r for r in rows}
    assert len(rows) == len(ROWS)
    assert by[2].keep == 1 and by[2].group_size == 2 and not by[2].kept
    assert by[6].keep == 5 and by[6].group_size == 3
    assert sum(r.kept for r in rows if r.key == 5) == 1
    kept = exact.unique(docs)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) - 3
    assert exact.duplicates(empty).count() == 0 and exact.unique(empty).count() == 0


def test_jaccard(docs, empty):
    rows = jaccard.similar(docs, words=4, share=85).collect()
    by = {r.key: r for r in rows}
    assert len(rows) == len(ROWS)
    assert [by[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert by[6].component == 5 and by[2].component == 2 and by[None].component is None
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 7, 8, 9, None}
    assert jaccard.similar(empty).count() == 0


def test_shards(docs, empty):
    rows = shards.shuffled_shards(docs, 3, "doc_id", bucket_rows=2).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s, n in enumerate((4, 4, 3)) for i in range(n)]
    assert sorted(str(r.row.doc_id) for r in rows) == sorted(str(r[0]) for r in ROWS)
    assert rows[0].row.asDict().keys() == set(docs.columns)
    assert shards.shuffled_shards(empty, 3, "doc_id").count() == 0
    # The long text asks for more buckets than the rows do.
    assert shards.bucket_count(docs)[1] == 1 and shards.bucket_count(empty) == (0, 1)
    size = sum(len((r[1] or "").encode()) + len(r[2] or "") + len(r[3] or "") + 16 for r in ROWS)
    assert shards.bucket_count(docs, bucket_bytes=10_000) == (len(ROWS), -(-size // 10_000))
    rows = shards.shuffled_shards(docs, 3, "doc_id", bucket_bytes=10_000).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s, n in enumerate((4, 4, 3)) for i in range(n)]


def test_mixing(docs, empty):
    counted = docs.withColumn("n_tokens", F.when(F.col("doc_id") > 2, F.length("text")))
    rows = mixing.mix(counted, ["doc_id"], max_repetition=2.0).collect()
    assert {r.doc_id for r in rows} == {r[0] for r in ROWS}
    drawn = mixing.mixed(docs)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == {r[0] for r in ROWS}
    assert mixing.mix(counted.limit(0), ["doc_id"], max_repetition=2.0).count() == 0
    assert mixing.mixed(empty).count() == 0


def test_packing(docs, empty):
    rows = packing.packed(packing.tokenized(docs, *FILES)).collect()
    assert sum(r.length for r in rows if r.key == 1) == 1
    assert len([r for r in rows if r.key == 5]) == 2
    assert packing.packed(packing.tokenized(empty, *FILES)).count() == 0


def test_chat(spark):
    schema = "tree long, node long, parent long, role string, text string, score double, rank long"
    messages = spark.createDataFrame(
        [
            (1, 0, None, "user", "hi", None, 0), (1, 1, 0, "assistant", "<|end|> a\\b", 1.0, 0), (1, 2, 0, "assistant", None, 2.0, 0),
            (1, 2, 0, "assistant", None, 2.0, 0), (1, 3, 2, None, "</s>[INST]", 0.5, 0),
            # A circle, an unknown parent, a node that is its own parent, a null tree.
            (2, 0, 1, "user", "x", 1.0, 0), (2, 1, 0, "user", "y", 1.0, 0), (2, 2, 1, "user", "z", 1.0, 0),
            (3, 5, 99, "user", "lost", 1.0, 0), (4, 0, 0, "user", "self", 1.0, 0), (None, 0, None, "user", "null", 1.0, 0),
        ],
        schema,
    )
    done = chat.format_paths(messages)
    rows = {(r.tree, r.leaf): r for r in done.collect()}
    assert set(rows) == {(1, 1), (1, 3), (3, 5), (4, 0), (None, 0)}
    assert rows[1, 3].rank == 0 and rows[1, 1].rank == 1 and rows[1, 3].n_turns == 3
    read = done.select("tree", "leaf", chat.read_turns(F.col("formatted")).alias("t"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"))
    read = {(r.tree, r.leaf): r for r in read.collect()}
    assert [tuple(t) for t in read[1, 1].t] == [("user", "hi"), ("assistant", "<|end|> a\\b")]
    assert read[1, 1].l == "<|end|> a\\b" and read[1, 3].l == ""
    assert [tuple(t) for t in read[1, 3].t] == [("user", "hi"), ("assistant", ""), ("", "</s>[INST]")]
    assert chat.format_paths(messages, top=1).filter("tree = 1").count() == 1
    assert chat.format_paths(messages.limit(0)).count() == 0


def test_long_threads(spark):
    """A chain of 300 replies with a branch at its middle, against a walk."""
    nodes = [(1, i, i - 1 if i else None) for i in range(300)] + [(1, 1000, 150)]
    paths = chat.reply_paths(spark.createDataFrame(nodes, "tree long, node long, parent long")).collect()
    got = {}
    for r in paths:
        got.setdefault(r.leaf, []).append((r.up, r.node))
    assert sorted(got[299]) == [(i, 299 - i) for i in range(300)]
    assert sorted(got[1000]) == [(0, 1000)] + [(i + 1, 150 - i) for i in range(151)]


def test_urls(spark):
    captures = spark.createDataFrame(
        [(1, "https://a.b.com/x/y?q", 5), (1, "https://a.b.com/x/y?q", 5), (2, None, 5), (3, "nonsense", 5), (4, "http://B.COM:80/", None), (5, "http://u@B.com:80/x", 30), (6, "http://a.b.com/x", 12)],
        "page_id long, url string, at long",
    ).withColumn("row", F.lit(1)).withColumn("salt", F.lit(1))
    entries = spark.createDataFrame(
        [
            ("block", "b.com", 1, "add"), ("block", "b.com", 10, "remove"), ("block", "b.com", 10, "add"), ("block", "b.com", 20, "remove"),
            ("allow", "a.b.com/x", 3, "add"), ("allow", "a.b.com/x", 9, "odd"), (None, "b.com", 1, "add"), ("block", None, 1, "add"), ("block", "b.com", None, "add"),
        ],
        "list string, pattern string, at long, action string",
    )
    rows = urls.judge(captures, entries).collect()
    assert len(rows) == 7
    by = {r.page_id: r for r in rows}
    assert by[1].pattern == "a.b.com/x" and not by[1].blocked and by[1].n_active == 2
    assert not by[2].blocked and not by[3].blocked and not by[4].blocked and not by[5].blocked
    assert by[6].blocked and by[6].pattern == "b.com" and by[6].since == 10
    assert urls.judge(captures, entries.limit(0)).filter("blocked").count() == 0
    assert urls.judge(captures.limit(0), entries).count() == 0


def test_chunks_ask_for_each_cell_once(monkeypatch):
    """Slices of one chunk share what they ask for, and texts come back from their slices."""
    monkeypatch.setattr(scoring, "SLICE", 200)
    texts = [None if i == 7 else b"The same few words again, and %d" % (i % 3) for i in range(60)]
    rows = pa.RecordBatch.from_arrays([pa.array(range(60)), pa.array(range(60)), pa.array(texts, pa.binary())], names=["key", "row", "text"])
    dealt = list(scoring._dealt(iter([rows])))
    assert len(dealt) > 5 and {b.column("chunk")[0].as_py() for b in dealt} == {0}
    lower = [(t or b"").lower() for t in texts]
    assert [t for b in dealt for t in scoring._texts(b.column("sizes")[0].as_py(), b.column("texts")[0].as_py())] == lower
    assert [k for b in dealt for k in b.column("key")[0].as_py()] == list(range(60))
    asked = list(scoring._asking(4)(iter(dealt)))
    cells = [c for b in asked for data in b.column("cells").to_pylist() for c in scoring._read_gaps(data).tolist()]
    assert cells == scoring._wanted(lower).tolist()


def test_shuffle_files_go_when_a_table_is_written(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        found = files.getAllFiles()
        return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}

    before = shuffled()
    stored = materialize(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "swept")
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.2)
    assert not shuffled() - before and stored.count() == 7
