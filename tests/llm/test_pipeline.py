"""Each stage on its own input, by what it must remove and what it must keep."""

import random

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from dossier.llm.tables import read_table
from tests.llm.util import documents, prose, words

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents before the first stage and after each, read back from files."""
    folder = tmp_path_factory.mktemp("stages")
    found = [read_table(spark, SF, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, found[-1], SF).write.parquet(f"{folder}/{name}")
        found.append(spark.read.parquet(f"{folder}/{name}"))
    return found


def ids(df):
    return [r.doc_id for r in df.select("doc_id").collect()]


def test_stages(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_dedup", "decontamination", "mixing"]
    for before, after in zip(stages[:-2], stages[1:-1], strict=True):
        assert after.columns == COLUMNS
        assert set(ids(after)) <= set(ids(before)) and 0 < after.count() <= before.count()
    assert stages[-1].columns == [*COLUMNS, "copies"]


def test_quality_stage_is_the_operator(spark, stages):
    from dossier.llm.queries import op9_quality_rules

    assert sorted(ids(stages[1])) == sorted(ids(op9_quality_rules(spark, SF).where("kept")))


def test_line_stage_against_brute_force(stages):
    from tests.llm.test_lines import as_report

    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: (r.text, r.n_chars) for r in stages[2].collect()}
    gone = as_report(list(before.items()), all_lines=True)
    for doc, text in before.items():
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(doc, (0, []))[1])
        assert after.get(doc) == ((kept, len(kept)) if words(kept) else None)


def test_simhash_stage_against_brute_force(stages):
    from tests.llm.test_simhash import expected_groups

    groups = expected_groups([(r.doc_id, r.text) for r in stages[2].collect()])
    assert sorted(ids(stages[3])) == sorted({component for _, _, component in groups})


def test_decontamination_stage_keeps_no_copy(spark, stages):
    from tests.llm.test_decontamination import plain, smith_waterman

    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = set(ids(stages[4]))
    for row in stages[3].collect():
        text = plain(row.text)
        near = [i for i in items if len(set(i) & set(text)) >= len(set(i)) // 2]
        worst = max((smith_waterman(i, text) / (2 * len(i)) for i in near), default=0)
        assert (row.doc_id in kept) == (worst < 0.5)


def test_mixing_stage_is_the_operator(spark, stages):
    from dossier.llm.mixing import mixture_sizes

    planned = {r.doc_id: r.copies for r in mixture_sizes(stages[4]).collect()}
    assert {r.doc_id: r.copies for r in stages[5].collect()} == {k: v for k, v in planned.items() if v}


def test_run_is_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, stages[-1].collect()))
    assert contract.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("number", range(5))
def test_stages_take_odd_rows(spark, number):
    rnd = random.Random(5)
    rows = [(i, prose(rnd, 90), "en", "a") for i in range(30)]
    rows += [(None, None, None, None), (None, prose(rnd, 60), None, None), (40, "", "en", "a"), (1, rows[1][1], "en", "a"), (41, prose(rnd, 9000), "de", "b")]
    docs = documents(spark, *rows)
    name, stage = corpus_pipeline.STAGES[number]
    found = stage(spark, docs, SF)
    assert found.columns[:5] == COLUMNS and set(ids(found)) >= ({*range(30), 41} if name != "mixing" else set())
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_queries_have_their_places():
    names = [n for n in contract.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert set(contract.oracle_sql()) <= set(contract.queries())
