"""Results of the operators against SQL, brute force, round trips and held-out rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from chorale.llm import exact, jaccard, langid, mixing, packing, quality, scoring, shards
from chorale.llm.queries import ORACLE, QUERIES
from tools.check_oracle import compare, connect

WORD = rb"[^\x20\x09-\x0d]+"


@pytest.fixture(scope="module")
def texts(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text", "lang").collect()
    return {r.doc_id: r for r in rows}


def crc(key: int) -> int:
    return zlib.crc32(str(key).encode())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data_dir, name):
    assert compare(spark, connect(data_dir), data_dir, name).startswith("ok")


def test_language_held_out(spark, data_dir, texts):
    rows = QUERIES["op3_language_id"](spark, data_dir).collect()
    assert len(rows) == len(texts) and all(r.held_out == (crc(r.doc_id) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out and len(texts[r.doc_id].text) > 200]
    assert sum(r.lang_pred == texts[r.doc_id].lang for r in held) >= 0.95 * len(held)


def test_language_mixture(spark, data_dir, texts):
    """Halves of two languages get about half each; one language alone gets all."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    model = langid.fit(docs)
    by = {lang: max((r.text for r in texts.values() if r.lang == lang), key=len)[:3000] for lang in ("en", "de", "fr")}
    made = spark.createDataFrame([(0, by["en"] + " " + by["de"]), (1, by["fr"]), (2, by["fr"] + " " + by["en"])], "doc_id long, text string")
    got = {r.key: {s.lang: s.share for s in r.shares} for r in langid.predict(made, model).collect()}
    assert abs(got[0]["en"] - 0.5) < 0.1 and abs(got[0]["de"] - 0.5) < 0.1
    assert got[1]["fr"] > 0.95 and abs(got[2]["fr"] - 0.5) < 0.1


def test_language_of_six():
    """Six languages in equal stretches each get a sixth; of three, none of the other languages gets a share."""
    scores = np.full((120, 8), -60.0)
    scores[np.arange(120), np.arange(120) % 6] = -20.0
    scores[60:] = -60.0
    scores[np.arange(60, 120), np.arange(60) % 3 + 5] = -20.0
    six, three = langid.infer(scores, np.array([0, 60]))
    assert np.allclose(six, [1 / 6] * 6 + [0, 0], atol=1e-3)
    assert np.allclose(three, [0] * 5 + [1 / 3] * 3, atol=1e-3)
    # A language that is second in every stretch is likeliest alone, and has no share in the end.
    scores[:60, 7] = -29.0
    assert np.allclose(langid.infer(scores[:60], np.array([0]))[0], [1 / 6] * 6 + [0, 0], atol=1e-3)


def test_language_labels_unbounded(spark):
    """More than 512 labels are all learnt, and a made document of six of them names the six."""
    words = {f"l{i:03d}": hashlib.md5(str(i).encode()).hexdigest().translate(str.maketrans("0123456789", "ghijklmnop")) for i in range(520)}
    train = spark.createDataFrame([(lang, f"{w} " * 40) for lang, w in words.items()], "lang string, text string")
    model = langid.fit(train)
    assert len(model[0]) == 520
    some = [f"l{i:03d}" for i in (3, 77, 140, 260, 390, 519)]
    made = spark.createDataFrame([(0, "".join(f"{words[x]} " * 30 for x in some))], "doc_id long, text string")
    got = {s.lang: s.share for s in langid.predict(made, model).first().shares}
    assert sorted(got) == some and all(abs(x - 1 / 6) < 0.05 for x in got.values())


def test_scoring_counts_and_scores(spark, data_dir, texts):
    rows = {r.doc_id: r for r in QUERIES["op4_lm_scoring"](spark, data_dir).collect()}

    def tokens(text):
        return [*re.findall(WORD, text.encode().lower()), b""]

    counts = Counter()
    for key, r in texts.items():
        if crc(key) % 5 != 1:
            counts.update(tokens(r.text))
    total, words = counts.total(), len(counts)
    for key, r in texts.items():
        own, got = tokens(r.text), rows[key]
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (words + 1))) for t in own)
        assert (got.n_tokens, got.n_known, got.train_tokens) == (len(own), sum(counts[t] > 0 for t in own), total)
        assert got.base_score == pytest.approx(base) and got.held_out == (crc(key) % 5 == 1)
        assert got.score < 0


def test_scoring_learns(spark):
    """Trained text is likelier than the same bytes in another order, and probabilities add up to one."""
    docs = spark.createDataFrame([(i, "the cat sat on the mat and the dog lay by the door") for i in range(50)], "doc_id long, text string")
    model = scoring.fit(docs)
    same, other = scoring.log_probabilities([b"the cat sat on the mat", b"eht tac tas no eht tam"], model.nodes)
    assert same > other + 20
    one_byte = [bytes([b]) for b in range(256)]
    first = np.exp(scoring.log_probabilities(one_byte, model.nodes))
    empty = np.exp(scoring.log_probabilities([b""], model.nodes))[0]
    # All texts of one byte and the empty one are a part of all texts.
    assert first.sum() + empty < 1
    # Texts side by side score as they do alone.
    alone = [scoring.log_probabilities([t], model.nodes)[0] for t in (b"", b"a cat", b"the door " * 300)]
    assert np.allclose(alone, scoring.log_probabilities([b"", b"a cat", b"the door " * 300], model.nodes))


def test_scoring_keeps_every_context(spark):
    """Contexts beyond any fixed number keep counts of their own: as many cells as brute force finds."""
    rng = np.random.default_rng(1)
    texts = [bytes(rng.integers(97, 123, 2000, dtype=np.uint8)) for _ in range(150)]
    model = scoring.fit(spark.createDataFrame([(t.decode(),) for t in texts], "text string"))
    expected = Counter()
    for text in texts:
        whole = bytes(scoring.APART) + text + b"\0"
        for i in range(scoring.APART, len(whole)):
            expected.update((n, whole[i - n : i], whole[i]) for n in scoring.BYTES_BACK)
            expected[0, whole[scoring.APART : i], whole[i]] += 1
    cells, counts = model.nodes
    assert len({c[:2] for c in expected}) > 300_000
    assert len(cells) == len(expected) and sorted(counts.tolist()) == sorted(expected.values())
    # The joins of whole tables give what the fetched table gives.
    docs = spark.createDataFrame([(i, t.decode()[:50]) for i, t in enumerate(texts[:5])], "doc_id long, text string")
    got = {r.key: r.score for r in scoring.score(docs, model).collect()}
    alone = scoring.log_probabilities([t[:50] for t in texts[:5]], model.nodes) / math.log(10)
    assert np.allclose([got[i] for i in range(5)], alone)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_with_collisions(spark, data_dir, texts, bits):
    """Hashes of three bits collide all over; contents keep texts apart."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    rows = exact.duplicates(docs, bits=bits).collect()
    groups = {}
    for key, r in texts.items():
        groups.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", r.text), []).append(key)
    for r in rows:
        text = re.sub(r"[\x20\x09-\x0d]+", " ", texts[r.key].text)
        assert (r.keep, r.group_size, r.kept) == (min(groups[text]), len(groups[text]), r.key == min(groups[text]))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_chunks_rejoin_and_realign():
    rng = np.random.default_rng(1)
    text = bytes(rng.integers(97, 123, 200_000, dtype=np.uint8))
    parts = exact.chunks(text)
    assert b"".join(parts) == text and max(map(len, parts)) <= exact.MOST
    shifted = exact.chunks(b"x" * 333 + text)
    assert len(set(parts) & set(shifted)) > 0.9 * len(parts)
    assert b"".join(exact.chunks(b"a" * 3_000_000)) == b"a" * 3_000_000


def all_pairs(texts: dict, words: int, share: int) -> dict:
    sets, holders, both = {}, {}, Counter()
    for key, text in texts.items():
        own = re.findall(WORD, (text or "").encode().lower())
        sets[key] = {tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set()
        for s in sets[key]:
            holders.setdefault(s, []).append(key)
    for keys in holders.values():
        both.update((a, b) for a in keys for b in keys if a < b)
    root = {k: k for k in texts}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for (a, b), n in both.items():
        if 100 * n >= share * (len(sets[a]) + len(sets[b]) - n):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {k: (len(sets[k]), find(k)) for k in texts}


@pytest.mark.parametrize(("words", "share"), [(4, 85), (5, 80), (2, 60)])
def test_jaccard_against_all_pairs(spark, data_dir, texts, words, share):
    """The given documents, and near copies of every size and distance made from them."""
    rng = np.random.default_rng(words)
    made = {k: r.text for k, r in texts.items()}
    source = max(made.values(), key=len).split()
    for size in (3, 5, 8, 13, 21, 40, 80, 250):
        base = source[size : 2 * size]
        for k in range(25):
            own = list(base)
            for _ in range(int(rng.integers(0, 1 + size // 6 + 2))):
                own[int(rng.integers(0, len(own)))] = f"edit{k}"
            made[10_000 + size * 100 + k] = " ".join(own[: len(own) - int(rng.integers(0, 2))])
    docs = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    got = {r.key: (r.n_shingles, r.component) for r in jaccard.similar(docs, words=words, share=share).collect()}
    assert got == all_pairs(made, words, share)


def test_components(spark):
    rng = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(70)] + [(2000, 2000 + i) for i in range(1, 80)]
    root = {x: x for link in links for x in link}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    got = {r.node: r.root for r in jaccard.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got.get(x, x) == find(x) for x in root)


def test_sharding_law(spark, data_dir, texts):
    rows = QUERIES["op7_sharding"](spark, data_dir).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {
        k: (len(r.text.encode()) + 16, zlib.crc32(r.text.encode())) for k, r in texts.items()
    }
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shuffle_mixes(spark):
    """Neighbours in the input end up apart, and buckets of one row or of all rows work."""
    for rows in (1, 64, 10_000):
        done = shards.shuffled_shards(spark.range(2000).withColumnRenamed("id", "doc_id"), 1, "doc_id", bucket_rows=rows)
        order = [r.row.doc_id for r in done.orderBy("slot").collect()]
        assert sorted(order) == list(range(2000))
        assert sum(abs(a - b) == 1 for a, b in zip(order, order[1:])) < 20


def test_exponent(spark):
    sources = spark.createDataFrame([("a", 9000), ("b", 900), ("c", 100), ("d", 0)], "source string, tokens long")
    p = np.array([0.9, 0.09, 0.01])

    def entropy(a):
        w = p**a / (p**a).sum()
        return -(w * np.log(w)).sum()

    a = mixing.find_exponent(sources, target_entropy=0.8)
    assert entropy(a) == pytest.approx(0.8, abs=1e-6)
    assert mixing.find_exponent(sources, target_entropy=5.0) == 0.0
    a = mixing.find_exponent(sources, max_repetition=3.0)
    assert (0.01 / 0.9) ** (a - 1) == pytest.approx(3.0)
    b = mixing.find_exponent(sources, max_repetition=4.0, budget=10_000)
    assert 0.01**b / (p**b).sum() / 0.01 == pytest.approx(4.0)
    assert mixing.find_exponent(sources, target_entropy=1.0, max_repetition=3.0) == pytest.approx(a)
    assert mixing.find_exponent(sources) == 1.0


def test_mixing_budget(spark):
    docs = spark.createDataFrame([(i, "a" if i % 10 else "b", 1 + i % 7) for i in range(3000)], "doc_id long, source string, n_tokens long")
    rows = mixing.mix(docs, ["doc_id"], max_repetition=2.0, budget=8000, blocks=16).collect()
    drawn, weight = Counter(), {}
    for r in rows:
        drawn[r.source] += r.n_tokens
        weight[r.source] = r.weight
    for source, tokens in drawn.items():
        assert 0 <= weight[source] * 8000 - tokens < 8
    places = {}
    for r in rows:
        places.setdefault((r.source, r.copy, r.block), []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in places.values())


def test_mixing_tiny_source(spark):
    """One word beside 1e11 tokens: no weight of 0, and no source repeats beyond the limit for it."""
    rows = [("tiny", 1, 1e-11 * 1.5), ("huge", 10**11, 1.0 - 1e-11 * 1.5), ("none", 0, 0.0)]
    weighted = spark.createDataFrame(rows, "source string, tokens long, weight double")
    got = {r.source: r for r in mixing.shared(weighted).collect()}
    assert (got["huge"].passes, got["huge"].rest) == (1, 0) and got["tiny"].passes == 1
    assert (got["none"].passes, got["none"].rest, got["none"].weight) == (1, 0, 0.0)
    # Given twice the tokens, the tiny source keeps its three words: twice its share of 1.5.
    assert {r.source: r.passes for r in mixing.shared(weighted, 2 * 10**11).collect()}["tiny"] == 3
    docs = spark.createDataFrame([(1, "tiny", 1), (2, "huge", 10**11)], "doc_id long, source string, n_tokens long")
    drawn = mixing.mix(docs, ["doc_id"], max_repetition=1.5).collect()
    assert sorted((r.source, r.copy) for r in drawn) == [("huge", 0), ("tiny", 0)]


def test_packing_against_whole_texts(spark, data_dir, texts):
    rows = QUERIES["op9_packing"](spark, data_dir).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    check_pieces(rows, {k: r.text for k, r in texts.items()}, tokenizer, 1)
    fill = sum(r.length for r in rows) / (1024 * len({r.sequence_id for r in rows}))
    assert fill > 0.97


def check_pieces(rows, texts, tokenizer, copies):
    ids = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t in texts.items()}
    by_sequence, starts = {}, {}
    for r in rows:
        own = ids[r.doc_id]
        assert r.doc_tokens == own.size and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
        starts.setdefault(r.doc_id, Counter())[(r.start, r.length)] += 1
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    for key, own in ids.items():
        want = {(s, min(1024, own.size - s)) for s in range(0, own.size, 1024)}
        times = set(starts[key].values())
        assert set(starts[key]) == want and len(times) == 1 and times.pop() >= copies


@pytest.mark.parametrize("text", [" a  b \n c\t\td  \n\n e ", " lead", "trail ", "a  b  c é'll I'm", "<|endoftext|> hi", "\n\n x", "x" * 5000, "", None])
def test_odd_spacing(text):
    files = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")]
    got = packing._Words(*files).ids(["plain words", text or "", "more of them"])[1]
    assert got.tolist() == Tokenizer.from_file(files[0]).encode(text or "", add_special_tokens=False).ids


def test_assembled(spark):
    files = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken")]
    docs = spark.createDataFrame([(i, "word " * (i * 7 % 90)) for i in range(60)], "doc_id long, text string")
    rows = packing.packed(packing.tokenized(docs, *files, size=64, keep_ids=True), 64)
    built = {r.sequence_id: r.ids for r in packing.assembled(rows, 64, pad=-1).collect()}
    assert all(len(x) == 64 for x in built.values())
    for r in rows.collect():
        assert built[r.sequence_id][r.offset : r.offset + r.length] == list(r.ids)


def test_cutoffs_merge(spark):
    """A small group takes its language's cut-offs; sketches of parts add up to the sketch of all."""
    docs = spark.createDataFrame(
        [(i, "en", "big", " ".join(f"word{(i * 31 + k) % 997}" for k in range(60))) for i in range(300)]
        + [(1000, "en", "tiny", " ".join(f"x{k}###***" for k in range(60))), (1001, "en", "tiny", " ".join(f"word{k}" for k in range(60)))],
        "doc_id long, lang string, source string, text string",
    )
    rows = {r.doc_id: r for r in quality.judge(docs).collect()}
    assert not rows[1000].kept and rows[1001].kept and all(rows[i].kept for i in range(300))
    measured = quality.measured(docs)
    parts = [quality.sketches(measured.filter(F.col("doc_id") % 3 == i)) for i in range(3)]
    added = parts[0].union(parts[1]).union(parts[2]).groupBy("lang", "source", "measure", "cell").agg(F.sum("n").alias("n"))
    assert sorted(map(tuple, added.collect())) == sorted(map(tuple, quality.sketches(measured).collect()))


def test_pipeline_against_brute_force(spark, data_dir, texts):
    live = {k: r.text for k, r in texts.items() if r.text and any(map(str.isalpha, r.text))}
    first = {}
    for k in sorted(live):
        first.setdefault(re.sub(r"[\x20\x09-\x0d]+", " ", live[k]), k)
    unique = {k: live[k] for k in first.values()}
    kept = {k: unique[k] for k, (_, root) in all_pairs(unique, 5, 80).items() if root == k}
    rows = corpus_pipeline.run(spark, data_dir).collect()
    assert {r.doc_id for r in rows} == set(kept)
    check_pieces(rows, kept, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 1)


def test_cutoffs_follow_a_group_without_repetition(spark):
    """Texts that pass the base rule but lie far outside their group are rejected by each measure."""
    def words(i, n):
        return [f"w{(i * 7919 + k * 104729) % 1000003}x" for k in range(n)]

    rows = [(i, "\n".join(" ".join(words(i * 40 + k, 10)) for k in range(10)), "en", "a") for i in range(400)]
    repeated = words(90_001, 100)
    repeated = " ".join(repeated[:86] + repeated[:14])
    lines = [" ".join(words(90_100 + k, 5)) for k in range(20)]
    planted = {
        "repeats": repeated,
        "dup_lines": "\n".join(lines[:14] + ["short one"] * 6 + [" ".join(words(90_200, 30))]),
        "symbols": " ".join(words(90_300, 100)) + " " + "#" * 60,
        "word_length": " ".join(w * 8 for w in words(90_400, 100)),
    }
    names = dict(enumerate(planted, 1000))
    rows += [(i, planted[name], "en", "a") for i, name in names.items()]
    judged = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    for r in judged:
        assert not r.base_failed
        assert r.kept == (r.doc_id < 1000), (r.doc_id, r.failed)
        if r.doc_id in names:
            assert names[r.doc_id] in r.failed
