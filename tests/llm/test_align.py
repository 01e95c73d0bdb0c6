"""Alignments against whole texts tokenized at once, with every pair of byte ranges looked at."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chorale.llm import align

FILES = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
TEXTS = [
    "Hello world, hello again", "été 漢字 😀x naïve 👩‍👩‍👧", "a  b\n c\t\td ", " lead", "<|endoftext|> <s> </s> <unk>", "x▁y z",
    "\0a \x1c b", "ﬁ Ǻ ｆｕｌｌ", "one", " ", "", None, "\r\n\r\n  x", "don't we'll THEY'RE 12345 67.8%", "été 漢字 😀x naïve 👩‍👩‍👧",
    "漢" * 400, "Ünïcödé  ÀÉ a b c　d", "tail  ", "<0x41> <0xE6>x",
]


def ranges(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(texts):
    """The contract, pair by pair."""
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    names, byte_of = {i: t for t, i in a.get_vocab().items()}, align._byte_of()
    rows, docs = [], Counter()
    for text in texts:
        links, groups, n_a, n_b = [], [], 0, 0
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in names[i]) for i in ids_a]
        bytes_b = [
            bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b
        ]
        raw = (" " + (text or "")).encode()
        if text and b"".join(bytes_a) == raw == b"".join(bytes_b):
            n_a, n_b = len(ids_a), len(ids_b)
            ra, rb = ranges(bytes_a), ranges(bytes_b)
            links = [(x, y) for x, (s, e) in zip(ids_a, ra) for y, (t, f) in zip(ids_b, rb) if s < f and t < e]
            last = 0
            for cut in sorted({e for _, e in ra} & {e for _, e in rb}):
                own = [[str(x) for x, (s, e) in zip(i, r) if last <= s and e <= cut] for i, r in ((ids_a, ra), (ids_b, rb))]
                groups.append("|".join(map(",".join, own)))
                last = cut
        docs.update(set(links))
        rows.append((n_a, n_b, groups, links))
    most = Counter()
    for (x, _), n in docs.items():
        most[x] = max(most[x], n)
    return [
        (
            n_a, n_b, len(groups), len(links), sum(docs[p] == most[p[0]] for p in links), sum(docs[p] for p in links),
            hashlib.sha256(";".join(groups).encode()).hexdigest() if n_a else "",
        )
        for n_a, n_b, groups, links in rows
    ]


def found(spark, texts):
    # Column names of the operator's own among the table's.
    df = spark.createDataFrame([(i, t, 1, "x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, batch long, key string, pairs array<long>")
    rows = align.alignments(df, *FILES).collect()
    assert sorted(r.key for r in rows) == list(range(len(texts)))
    return [tuple(r)[1:5] + (r.n_best, r.count_sum, r.groups_sha256) for r in sorted(rows, key=lambda r: r.key)]


def test_equals_whole_texts(spark):
    assert found(spark, TEXTS) == plain(TEXTS)


def test_sample_documents(spark, data_dir):
    texts = [r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").orderBy(F.length("text")).limit(120).collect()]
    assert found(spark, texts) == plain(texts)


def test_slices_and_batches_change_nothing(monkeypatch):
    long = " ".join(f"wort{i % 700} 漢{i % 31}\n x" for i in range(3000))
    whole = align.Aligner(*FILES).document(long)
    monkeypatch.setattr(align, "SLICE", 500)
    monkeypatch.setattr(align, "HELD", 50)
    cut = align.Aligner(*FILES).document(long)
    assert whole[:2] == cut[:2] and (whole[2] == cut[2]).all() and (whole[3] == cut[3]).all()


def test_a_text_above_every_slice(spark):
    long = " ".join(f"w{i % 5000}" for i in range(900_000))
    assert len(long) > align.BATCH > align.SLICE
    (row,) = found(spark, [long])
    (want,) = found(spark, [" ".join(f"w{i}" for i in range(5000))])
    assert row[3] == 180 * want[3] and row[0] == 180 * want[0] and row[5] == row[3]


def test_groups_cover_the_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    rows = align.groups(df, *FILES).orderBy("key", "at").collect()
    for i, want in enumerate(plain(TEXTS)):
        own = [r for r in rows if r.key == i]
        assert len(own) == want[2] and sum(len(r.a) for r in own) == want[0]
        if own:
            assert b"".join(TEXTS[i].encode()[r.start : r.end] for r in own) == TEXTS[i].encode()


@pytest.mark.parametrize("rows", [[], [(None, None), (None, ""), (3, "a"), (3, "a")]])
def test_nulls_repeats_and_no_rows(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    done = align.alignments(df, *FILES).collect()
    assert len(done) == len(rows)
    assert sorted(r.n_a for r in done) == [0, 0, 1, 1][: len(rows)]
