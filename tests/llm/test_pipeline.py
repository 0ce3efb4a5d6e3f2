from __future__ import annotations

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import difference
from tests.llm.test_exact import lowered
from tests.llm.test_packing import check as check_packs
from tests.llm.test_simhash import brute_force as near_groups
from tests.llm.test_suffix_dedup import brute_force as cut_bytes
from ticketlake.config import fresh_dir
from ticketlake.llm import packing
from ticketlake.llm.oracle import LLM_ORACLE
from ticketlake.llm.queries import LLM_QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_DIR}/documents.parquet'")
    got = LLM_QUERIES[name](spark, SF_DIR).toPandas()
    assert not difference(got, con.execute(LLM_ORACLE[name]).df())


def test_every_operator_has_a_query():
    numbers = [int(name.split("_")[0].removeprefix("op")) for name in LLM_QUERIES]
    assert numbers == list(range(1, 14))


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        path = fresh_dir(spark, "stage")
        stage(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append(docs)
    scored, exact, near, cut, packed = ([r.asDict() for r in d.collect()] for d in kept)
    assert all(d.columns == columns for d in kept[:-1])

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    scored_ids = {r["doc_id"] for r in scored}
    clean = [i for i, q in labels.items() if q == 1]
    assert sum(i in scored_ids for i in clean) >= 0.97 * len(clean)
    assert sum(labels.get(i) == 0 for i in scored_ids) <= 0.2 * sum(q == 0 for q in labels.values())

    last = {}
    for r in scored:
        last[lowered(r["text"])] = max(r["doc_id"], last.get(lowered(r["text"]), -1))
    assert {r["doc_id"] for r in exact} == set(last.values()) and len(exact) == len(last)

    rows = [(r["doc_id"], r["text"]) for r in exact]
    assert {r["doc_id"] for r in near} == {i for i, _, root in near_groups(rows, 3, 3) if i == root}

    want = {i: bytes(kept) for i, _, _, _, kept in cut_bytes([(r["doc_id"], r["text"]) for r in near], 100)}
    got = {r["doc_id"]: r["text"].encode() for r in cut}
    assert got.keys() == want.keys()
    # the texts also keep the characters that a cut would part: a few bytes at most beside each cut
    assert sum(len(got[i]) - len(want[i]) for i in got) < 0.01 * sum(map(len, want.values()))
    assert all(r["n_chars"] == len(r["text"]) for r in cut)

    sizes = [(r["doc_id"], len(r["text"].encode())) for r in cut]
    check_packs(kept[-1], sizes, packing.CONTEXT, packing.BATCH_TOKENS, packing.BUCKETS)
    assert len(packed) >= len(cut)


@pytest.fixture
def odd_docs(docs, odd_rows):
    """The odd rows with the columns of documents and further ones of clashing names."""
    more = {"quality_score": F.lit("mine"), "Quality_Score_": F.lit("too"), "lang": F.lit(None).cast("string")}
    return docs(odd_rows).withColumns({"n_chars": F.length("text").cast("long"), **more})


def test_stages_keep_the_columns_and_rows_of_odd_tables(spark, odd_docs, odd_rows):
    by_name = dict(corpus_pipeline.STAGES)
    rows = {name: stage(spark, odd_docs, SF_DIR) for name, stage in corpus_pipeline.STAGES}
    for name, table in rows.items():
        if name != "packing":
            assert table.columns == odd_docs.columns
            assert all((r["quality_score"], r["Quality_Score_"], r["block"]) == ("mine", "too", "x") for r in table.collect())
    given = Counter(odd_rows)
    scored = Counter((r["doc_id"], r["text"]) for r in rows["quality classifier"].collect())
    assert all(scored[r] in (0, given[r]) for r in given) and set(scored) <= set(given)  # equal rows share a verdict
    verdicts = {}
    assert all(verdicts.setdefault(t or "", scored[i, t] > 0) == (scored[i, t] > 0) for i, t in given)

    exact = [(r["doc_id"], r["text"]) for r in rows["exact dedup"].collect()]
    assert sorted(lowered(t) for _, t in exact) == sorted({lowered(t) for _, t in odd_rows}) and set(exact) <= set(given)
    near = [(r["doc_id"], r["text"]) for r in rows["SimHash near-dedup"].collect()]
    assert len(near) == len(set(near)) and set(near) <= set(given)
    # one row a group; groups of rows that share an id may have it as their smallest both
    assert {i for i, _ in near} == {root for _, _, root in near_groups(odd_rows, 3, 3)}
    cut = rows["suffix-array dedup"].collect()
    assert Counter(r["doc_id"] for r in cut) == Counter(i for i, _ in odd_rows)
    assert all(r["text"] is not None and r["n_chars"] == len(r["text"]) for r in cut)
    assert {r["doc_id"] for r in rows["packing"].collect()} == {i for i, _ in odd_rows}
    assert list(by_name) == ["quality classifier", "exact dedup", "SimHash near-dedup", "suffix-array dedup", "packing"]


def test_stages_give_nothing_for_empty_tables(spark, odd_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd_docs.limit(0), SF_DIR).count() == 0
