import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.llm import bloom, scoring
from dossier.llm.queries import op4_lm_scores
from dossier.llm.scoring import EDGES, VALUES, is_held_out, level_of, score_documents
from tests.llm.util import documents, prose, words

SF = "/root/testdata/sf0.001"
END = b"\n"


def tokens(text):
    return [*words(text, lower=True), END]


def rounded(n, least):
    return VALUES[int(level_of(np.array(n)))] if n >= least else 0.0


class Reference:
    """The model with exact tables in place of the filter."""

    def __init__(self, texts, least=1):
        self.words, self.pairs, self.least = Counter(), Counter(), least
        for text in texts:
            found = tokens(text)
            self.words.update(found)
            self.pairs.update(zip([END, *found], found, strict=False))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.norm = self.n + 0.5 * (self.v + 1)

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.5) / self.norm) for w in tokens(text))

    def score(self, text):
        total, found = 0.0, tokens(text)
        for before, word in zip([END, *found], found, strict=False):
            alone = (rounded(self.words[word], self.least) + 0.5) / self.norm
            together = rounded(self.pairs[before, word], self.least)
            first = max(rounded(self.words[before], self.least), together)
            total += math.log10((together + scoring.PRIOR * alone) / (first + scoring.PRIOR))
        return total


def check(rows, reference, texts):
    assert len(rows) == len(texts)
    for row in rows:
        text = texts[row.doc_id]
        found = tokens(text)
        assert (row.n_tokens, row.n_known) == (len(found), sum(reference.words[w] > 0 for w in found))
        assert row.train_tokens == reference.n
        assert row.base_score == pytest.approx(reference.base(text), rel=1e-9)
        assert row.score == pytest.approx(reference.score(text), rel=1e-4)


def corpus():
    rnd = random.Random(8)
    texts = [prose(rnd, rnd.randrange(1, 120)) for _ in range(60)]
    texts += [texts[3]] * 30 + ["", None, " \t\n", prose(rnd, 15_000), "Never seen words, these: É é"]
    return texts


@pytest.mark.parametrize("table_words", [1, 40, 1 << 16])
def test_against_exact_tables(spark, table_words):
    """Small tables send most words through the join."""
    texts = corpus()
    docs = documents(spark, *texts).withColumnRenamed("lang", "n_known").withColumnRenamed("source", "gram").repartition(3)
    rows = score_documents(docs, docs.where("doc_id % 4 != 1"), table_words=table_words, log2_bits=22).collect()
    check(rows, Reference([t for i, t in enumerate(texts) if i % 4 != 1]), texts)


def test_a_full_filter_leaves_out_the_rarest(spark):
    """A cutoff that all n-grams decide: fewer bits, fewer n-grams, and the exact score unchanged."""
    texts = corpus()
    docs = documents(spark, *texts)
    rows = {r.doc_id: r for r in score_documents(docs, docs, log2_bits=bloom.BLOCK_BITS - 6).collect()}
    reference = Reference(texts)
    for i, text in enumerate(texts):
        assert rows[i].base_score == pytest.approx(reference.base(text), rel=1e-9)
        assert rows[i].score < 0


def test_levels_round_counts():
    counts = np.array([0, 1, 2, 3, 100, 10**6, 10**12])
    assert VALUES[level_of(counts)][:3].tolist() == [0.0, 1.0, 2.0]
    assert np.all(np.abs(np.log(VALUES[level_of(counts[1:])] / counts[1:])) < math.log(scoring.STEP))
    assert np.all(np.diff(EDGES) > 0)


def test_filter_has_what_went_in(spark):
    rnd = random.Random(1)
    keys = {rnd.getrandbits(64): rnd.randrange(1, 30) for _ in range(3000)}
    signed = [(k - (1 << 64) if k >> 63 else k, level) for k, level in keys.items()]
    rows = spark.createDataFrame(signed, "key bigint, level int").repartition(5)
    for log2_bits in (20, 22):
        filled = bloom.build(rows, log2_bits)
        found = filled.levels(np.array(list(keys), np.uint64))
        assert np.all(found >= list(keys.values()))
        assert (found == list(keys.values())).mean() > 0.9
        others = np.array([rnd.getrandbits(64) for _ in range(5000)], np.uint64)
        assert filled.has(others).mean() < 0.2
    assert not bloom.build(rows.limit(0), 20).has(others).any()


def test_probabilities_sum_to_one():
    """Over all words and one unseen one, for counts that the levels keep exactly."""
    texts = ["a b a c", "a b", "b a c a b"]
    reference = Reference(texts, least=1)
    vocabulary = [*reference.words, b"unseen"]
    total = sum(
        (reference.pairs[b"a", w] + scoring.PRIOR * (reference.words[w] + 0.5) / reference.norm)
        / (reference.words[b"a"] + scoring.PRIOR)
        for w in vocabulary
    )
    assert total == pytest.approx(1.0)


def test_no_training_documents_and_no_rows(spark):
    docs = documents(spark, "some words here", None)
    rows = score_documents(docs, docs.limit(0), log2_bits=20).collect()
    assert [(r.n_known, r.train_tokens, r.base_score) for r in rows] == [(0, 0, 0.0)] * 2
    assert score_documents(documents(spark), documents(spark), log2_bits=20).count() == 0


def test_split(spark):
    rows = spark.createDataFrame([(i,) for i in [*range(50), None]], "i bigint")
    for row in rows.select("i", is_held_out(F.col("i")).alias("held")).collect():
        assert row.held == (row.i is not None and zlib.crc32(str(row.i).encode()) % 5 == 1)


def test_query_against_exact_tables(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 1}
    rows = op4_lm_scores(spark, SF).collect()
    check(rows, Reference([t for i, t in texts.items() if i not in held]), texts)
    assert {r.doc_id for r in rows if r.held_out} == held


def test_pairs_help_on_held_out_texts(spark):
    """Texts with habits: the model gives them more than single words do."""
    rnd = random.Random(6)

    def habit(n):
        found = ["w0"]
        for _ in range(n):
            found.append(f"w{(int(found[-1][1:]) * 7 + rnd.randrange(3)) % 50}")
        return " ".join(found)

    docs = documents(spark, *[habit(200) for _ in range(60)])
    rows = score_documents(docs, docs.where("doc_id < 40"), log2_bits=22).where("doc_id >= 40").collect()
    assert all(r.score > r.base_score + 0.2 * r.n_tokens for r in rows)


def test_more_ngrams_than_one_filter_holds(spark):
    """All stay in: pairs seen twice count as with exact tables, whatever the size of a part."""
    rnd = random.Random(11)
    once = [prose(rnd, 400, 10**6) for _ in range(120)]
    texts = once + once
    reference = Reference(texts)
    held = [*reference.words.values(), *reference.pairs.values()]
    assert sum(level_of(np.array(held))) > (1 << bloom.BLOCK_BITS) * math.log(2) / bloom.PROBES
    docs = documents(spark, *texts).repartition(3)
    rows = score_documents(docs, docs, log2_bits=bloom.BLOCK_BITS).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.score == pytest.approx(reference.score(texts[row.doc_id]), rel=0.02)


def test_parts_add_up(spark, monkeypatch):
    """Parts with so few n-grams that nothing is found by mistake give the exact tables' scores."""
    monkeypatch.setattr(scoring, "_room", lambda log2_bits: 4000.0 * 2.0 ** (log2_bits - 20))
    texts = corpus()
    docs = documents(spark, *texts).repartition(3)
    rows = score_documents(docs, docs.where("doc_id % 4 != 1"), table_words=40, log2_bits=20).collect()
    check(rows, Reference([t for i, t in enumerate(texts) if i % 4 != 1]), texts)


@pytest.mark.parametrize("room", [1e9, 6000.0, 1500.0])
def test_the_number_of_parts_changes_no_score(spark, monkeypatch, room):
    """One part and many, over texts that repeat, are empty or long; rows without an id are scored too."""
    monkeypatch.setattr(scoring, "_room", lambda log2_bits: room * 2.0 ** (log2_bits - 20))
    texts = corpus()
    docs = documents(spark, *texts).withColumnRenamed("lang", "part").withColumnRenamed("source", "rows").repartition(3)
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 7, F.col("doc_id")))
    _, grams, _ = scoring.train(docs, log2_bits=20)
    if room == 1e9:
        assert grams.parts is None
    else:
        # In the smaller ones a common word, or the end, has too many pairs for one.
        assert grams.parts.number > (3 if room == 6000.0 else 12)
        assert (grams.parts.spread > 1) == (room == 1500.0)
    rows = score_documents(docs, docs, log2_bits=20).collect()
    reference = Reference(texts)
    assert sum(r.doc_id is None for r in rows) == 1
    assert next(r for r in rows if r.doc_id is None).score == pytest.approx(reference.score(texts[7]), rel=1e-4)
    check([r for r in rows if r.doc_id is not None], reference, {i: t for i, t in enumerate(texts) if i != 7})


def test_too_few_parts_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(scoring, "_room", lambda log2_bits: 1.0)
    docs = documents(spark, *corpus())
    with pytest.raises(ValueError, match="give more bits"):
        score_documents(docs, docs, log2_bits=20)


def test_packing():
    """No part beyond its room, every tag in one part or in those that are spread, words of the latter in all of these."""
    rnd = np.random.default_rng(5)
    words, pairs = rnd.integers(0, 5, 4096).astype(float), rnd.integers(0, 300, 4096).astype(float)
    pairs[[17, 900]] = 70_000, 9_000
    parts, most = scoring._packed(words, pairs, 10_000.0)
    assert most <= 10_000 and set(np.flatnonzero(parts.own < 0)) == {17, 900}
    assert parts.packed <= 1.1 * (words + pairs)[parts.own >= 0].sum() / 10_000 + 1
    assert np.bincount(parts.own[parts.own >= 0], (words + pairs)[parts.own >= 0]).max() <= 10_000
    grams = rnd.integers(0, 1 << 63, 50_000).astype(np.uint64)
    grams = np.append(grams, (grams[:20_000] >> np.uint64(13) << np.uint64(13)) | np.uint64(17 << 1 | 1))
    of = parts.of(grams)
    assert of.min() >= 0 and of.max() < parts.number
    counts = np.bincount(of[-20_000:], minlength=parts.number)
    assert not counts[: parts.packed].any() and counts[parts.packed :].min() > 0.9 * 20_000 / parts.spread
    index, each = parts.of_all(grams)
    assert set(zip(range(len(grams)), of.tolist())) <= set(zip(index.tolist(), each.tolist()))
    heavy = np.flatnonzero((parts.own[(grams >> np.uint64(1)).astype(np.int64) & 4095] < 0) & (grams % 2 == 0))
    times = np.bincount(index)
    assert len(heavy) and (times[heavy] == parts.spread).all()
    assert times.sum() == len(grams) + len(heavy) * (parts.spread - 1)
