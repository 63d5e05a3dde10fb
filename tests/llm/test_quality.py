import random
from collections import Counter

import numpy as np
import pytest

from dossier.llm.quality import REACH, SPREADS, TWO_SIDED, keep_good, limits, measure, quality_verdicts, sketch
from dossier.llm.queries import op9_quality_rules
from tests.llm.util import documents, prose, words

SF = "/root/testdata/sf0.001"


def counts(text):
    """The base counts, by the contract's words."""
    text = text or ""
    found = words(text)
    windows = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return {
        "n_words": len(found),
        "word_chars": sum(len(w.decode()) for w in found),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
    }


def failed(c):
    return c["n_words"] < 50 or 100 * c["n_repeat_words"] > 50 * c["n_words"]


def test_counts_of_odd_texts(spark):
    rnd = random.Random(1)
    texts = [prose(rnd, n, 30) for n in (1, 2, 3, 49, 50, 400)]
    texts += [None, "", "\n\n", "a a a", "a a a a", "x y z x y z", "é# 😀| <b>\n\n \t\na b\na b \na b\r\na b\r", "a\x0bb\x0cc\x85d", "w " * 30_000]
    texts += ["x y z q x y", "\n".join(["line one here"] * 5), "z" * 3000 + "\n" + "z" * 3000]
    df = documents(spark, *texts).withColumnRenamed("n_chars", "n_lines").repartition(3)
    for row in measure(df.drop("n_lines")).collect():
        expected = counts(texts[row.doc_id])
        assert {k: row[k] for k in expected} == expected, texts[row.doc_id]
        assert row.base_failed == failed(expected)


def test_sketches_merge_and_keep_quartiles(spark):
    rnd = random.Random(2)
    texts = [prose(rnd, 60) + " #" * rnd.randrange(40) for _ in range(300)]
    df = measure(documents(spark, *[(i, t, "en", f"s{i % 2}") for i, t in enumerate(texts)]))
    once = sorted(map(tuple, sketch(df).collect()))
    halves = sketch(df.where("doc_id < 100")).unionByName(sketch(df.where("doc_id >= 100")))
    merged = Counter()
    for *key, n in halves.collect():
        merged[tuple(key)] += n
    assert once == sorted((*k, n) for k, n in merged.items())
    found = {r.source: r for r in limits(sketch(df), min_group=1).collect()}
    for source in ("s0", "s1"):
        for name in SPREADS:
            values = sorted(r[name] for r in df.where(f"source = '{source}'").collect())
            low, high = (values[int(np.ceil(q * len(values))) - 1] for q in (0.25, 0.75))
            most = high + REACH * max(high - low, SPREADS[name])
            assert found[source][f"{name}_most"] == pytest.approx(most, rel=0.05, abs=0.01)
            if name in TWO_SIDED:
                assert found[source][f"{name}_least"] == pytest.approx(
                    low - REACH * max(high - low, SPREADS[name]), rel=0.1, abs=0.05
                )


def test_small_groups_take_wider_limits(spark):
    rnd = random.Random(3)
    rows = [(i, prose(rnd, 60), "en", "big") for i in range(40)] + [(100, prose(rnd, 60), "en", "small")]
    rows += [(200, prose(rnd, 60), "xx", None), (201, prose(rnd, 60), None, None)]
    found = {(r.lang, r.source): r for r in limits(sketch(measure(documents(spark, *rows))), min_group=20).collect()}
    name = "mean_word_length_most"
    assert set(found) == {("en", "big"), ("en", "small"), ("xx", None), (None, None)}
    assert found["en", "small"][name] == pytest.approx(found["en", "big"][name], rel=0.05)
    assert found["xx", None][name] == found[None, None][name]


def junk(rnd, kind):
    plain = prose(rnd, 120)
    return {
        "symbols": plain.replace(" ", " ### "),
        "shout": plain.upper(),
        "lines": "\n".join([prose(rnd, 6)] * 30 + [plain]),
        "short": "few words",
        "repeats": "again and again and " * 40,
    }[kind]


def test_junk_goes_and_clean_stays(spark):
    rnd = random.Random(4)
    rows = [(i, prose(rnd, 150), "en", "s0" if i % 3 else "s1") for i in range(400)]
    kinds = ["symbols", "shout", "lines", "short", "repeats"]
    rows += [(1000 + i, junk(rnd, k), "en", "s0") for i, k in enumerate(kinds * 3)]
    rows += [(2000, None, None, None), (2001, "", "en", None), (2002, prose(rnd, 20_000), "en", "s0"), (1, rows[1][1], "en", "s0")]
    docs = documents(spark, *rows).withColumnRenamed("n_chars", "kept").repartition(4)
    verdicts = quality_verdicts(docs)
    kept = sorted(r.doc_id for r in verdicts.where("kept").collect())
    assert kept == sorted([*range(400), 1, 2002]) and verdicts.count() == len(rows)
    good = keep_good(docs)
    assert good.columns == docs.columns and sorted(r.doc_id for r in good.collect()) == kept


def test_empty_table(spark):
    assert quality_verdicts(documents(spark)).count() == 0
    assert keep_good(documents(spark)).count() == 0


def test_query_against_brute_force(spark):
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op9_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for row in rows:
        expected = counts(docs[row.doc_id].text)
        assert {k: row[k] for k in expected} == expected
        assert row.base_failed == failed(expected) and not (row.base_failed and row.kept)


def test_kept_follows_the_labels(spark):
    """Labelled tables: low quality goes, and what passes the base rules and is labelled good mostly stays."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = op9_quality_rules(spark, sf).join(labels, "doc_id").collect()
    assert not any(r.kept for r in rows if r.quality == 0)
    good = [r.kept for r in rows if r.quality == 1 and not r.base_failed]
    assert sum(good) >= 0.99 * len(good)


def test_small_sources_are_judged_by_their_own_documents(spark):
    """A small source with many symbols, and a rare language with long words, keep their clean documents."""
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 120), "en", "s0") for i in range(300)]
    rows += [(1000 + i, prose(rnd, 120).replace(" ", "# "), "en", "tables") for i in range(30)]
    rows += [(2000 + i, prose(rnd, 120).replace("w", "w" * 25), "xx", "s0") for i in range(30)]
    rows += [(3000 + i, prose(rnd, 120).replace(" ", "# "), "en", "s0") for i in range(3)]
    kept = sorted(r.doc_id for r in quality_verdicts(documents(spark, *rows)).where("kept").collect())
    assert kept == [i for i, *_ in rows if i < 3000]
