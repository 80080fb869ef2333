import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
import corpus_pipeline as pipeline  # noqa: E402
from edges import by_id, documents  # noqa: E402
from roamgrid.llm import minhash_dedup, mixing, packing, pii_crf  # noqa: E402
from roamgrid.llm import queries as llm  # noqa: E402
from roamgrid.llm.shared import table  # noqa: E402
from test_minhash_dedup import expected  # noqa: E402
from test_mixing_packing import check_packing  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    docs, out = table(spark, SF, "documents"), []
    for _, stage in pipeline.STAGES:
        out.append(docs)
        docs = pipeline.materialize(stage(spark, docs, SF), "stage")
    return [*out, docs]


def test_every_stage_on_what_the_last_kept(spark, results):
    start, good, single, masked, mixed, packed = results
    assert all(r.columns == start.columns for r in results[:5])
    marks = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    kept = set(by_id(good))
    assert sum(q == 1 and i not in kept for i, q in marks.items()) <= 1 and sum(q == 0 and i in kept for i, q in marks.items()) <= 2

    rows = sorted(good.collect(), key=lambda r: r["doc_id"])
    root, _ = expected([r["text"] for r in rows], 5)
    assert sorted(by_id(single)) == [r["doc_id"] for i, r in enumerate(rows) if root[i] == i]

    before, after = by_id(single), by_id(masked)
    assert set(before) == set(after)
    for i, (row,) in after.items():
        assert row["n_chars"] == len(row["text"])
        if not pii_crf.base_spans(before[i][0]["text"]):
            assert row["text"] == before[i][0]["text"] or "<" in row["text"]
        assert not [s for s in pii_crf.base_spans(row["text"]) if s[0] != 3]

    copies = {r["doc_id"]: r["copies"] for r in mixing.curriculum(masked).collect()}
    counted = {i: len(v) for i, v in by_id(mixed).items()}
    assert counted == {i: c for i, c in copies.items() if c}

    once = packed.dropDuplicates(["doc_id", "piece"]).collect()
    sizes = {i: len(v[0]["text"].split()) for i, v in by_id(mixed).items()}
    assert {(p["doc_id"]) for p in once} == set(sizes)
    assert packed.count() == sum(counted[p["doc_id"]] for p in once)
    assert sum(p["n_words"] for p in packed.collect()) == sum(n * counted[i] for i, n in sizes.items())
    single_copy = [p for p in packed.collect() if counted[p["doc_id"]] == 1]
    assert all(len(p) == len(packed.columns) for p in single_copy)
    check_packing([p for p in packing.pack(masked).collect()], {i: len(v[0]["text"].split()) for i, v in after.items()}, packing.CAPACITY)


def test_stages_on_awkward_rows(spark):
    docs = documents(spark)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert name == "packing" or out.columns == docs.columns, name
        assert out.count() > 0, name
        assert stage(spark, documents(spark, []), SF).count() == 0, name
    single = by_id(pipeline.dedup(spark, docs, SF))
    assert set(single) == {1, 4, 5, 6, 7, 9, 10, 11, 12, 13, None} and len(single[11]) == 1 and len(single[None]) == 2


def test_texts_of_one_id_are_judged_each(spark):
    from edges import words

    a, b, c = (" ".join(words(seed, 80)) for seed in (21, 22, 23))

    def kept(rows):
        out = pipeline.dedup(spark, documents(spark, [(i, t, "en", "a", 0, 0.5, "k", "c") for i, t in rows]), SF)
        return sorted((r["doc_id"], r["text"]) for r in out.collect())

    assert kept([(1, a), (5, a), (5, b)]) == sorted([(1, a), (5, b)])
    assert kept([(5, a), (5, b), (7, c)]) == sorted([(5, a), (5, b), (7, c)])
    assert kept([(5, a), (5, a), (5, b), (5, b), (7, b + " more")]) == sorted([(5, a), (5, b)])
    assert len(kept([(5, a), (5, a.upper()), (9, "")])) == 2


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(llm.ORACLES) <= set(llm.QUERIES) <= names and set(llm.ORACLES) <= set(entry.oracle_sql())
    assert minhash_dedup.NEED < minhash_dedup.SKETCH


@pytest.mark.parametrize("name", sorted(llm.ORACLES))
def test_query_against_sql(spark, name):
    from compare import connect, differences

    assert differences(llm.QUERIES[name](spark, SF), connect(SF), llm.ORACLES[name]) is None
