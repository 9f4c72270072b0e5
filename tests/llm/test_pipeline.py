"""The pipeline against a plain version of each stage, and the registered queries."""

import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline as cp
from clearshelf.llm import decontaminate, toxicity
from clearshelf.sources.tables import stage
from test_similar import brute_kept


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    """The rows after each stage, as the driver runs them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, function in cp.STAGES:
        out.append(stage(function(spark, out[-1], sf_dir), name))
    return out


def ids(df):
    return collections.Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_and_columns(steps):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "sharding"]
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns
    assert steps[-1].columns == [*steps[0].columns, "size", "text_crc32", "shard", "slot"]


def test_toxic_documents_go(spark, sf_dir, steps):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score_documents(steps[0], labels).collect()
    assert ids(steps[1]) == collections.Counter(r.row.doc_id for r in scored if not r.predicted)
    assert 0 < steps[1].count() < steps[0].count()


def test_the_first_of_each_group_of_near_copies_stays(steps):
    before = {r.doc_id: r.text or "" for r in steps[1].collect()}
    assert ids(steps[2]) == collections.Counter(brute_kept(before))
    assert steps[2].count() < steps[1].count()
    texts = [r.text for r in steps[2].collect()]
    assert len(texts) == len(set(texts))


def test_contaminated_documents_go(spark, sf_dir, steps):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gone = ids(steps[2]) - ids(steps[3])
    found = decontaminate.report(steps[2], benchmark).collect()
    assert gone == collections.Counter(r.row.doc_id for r in found if r.contaminated)
    assert gone


def test_the_mix_copies_documents(steps):
    before, after = ids(steps[3]), ids(steps[4])
    assert set(after) <= set(before) and max(after.values()) <= 3
    words = {r.doc_id: len((r.text or "").split()) for r in steps[3].collect()}
    total = sum(words.values())
    taken = sum(words[i] * n for i, n in after.items())
    assert taken == pytest.approx(total, rel=0.05)


def test_shards_hold_all_rows(steps):
    rows = steps[5].collect()
    assert collections.Counter(r.doc_id for r in rows) == ids(steps[4])
    counts = collections.Counter(r.shard for r in rows)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(n))


def test_every_operator_is_registered_once():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert entry.queries()["pipeline"] is cp.run


def test_an_empty_corpus_passes_all_stages(spark, sf_dir, steps):
    docs = steps[0].limit(0)
    for name, function in cp.STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    assert docs.count() == 0


def test_odd_rows_pass_all_stages(spark, sf_dir, docs_of):
    rows = [(None, None, None), (1, None, None), (1, None, None), (2, "", "a"), (3, "x " * 20_000, "a"), (4, "A b c", "b")]
    docs = docs_of(rows)
    for name, function in cp.STAGES:
        docs = stage(function(spark, docs, sf_dir), name)
    assert {r.doc_id for r in docs.collect()} <= {None, 1, 2, 3, 4}
