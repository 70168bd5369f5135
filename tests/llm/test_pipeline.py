import re
from fractions import Fraction

import pytest
from .test_jaccard import brute

import __spark_entry__ as entry
import corpus_pipeline
from rillmark.llm.decontamination import contaminated
from rillmark.llm.frames import given, stored
from rillmark.llm.secrets import MARK

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs, out = given(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "test")
        out.append((name, docs, after))
        docs = after
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_all_but_the_last_keep_the_columns(stages):
    assert len(stages) == 5
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes and after.count() > 0


def test_toxicity_keeps_clean_documents(spark, stages):
    _, before, after = stages[0]
    toxic = given(spark, SF, "labels").where("toxic = 0").select("doc_id").join(before, "doc_id")
    kept = set(ids(after))
    clean = ids(toxic)
    assert sum(k in kept for k in clean) >= 0.97 * len(clean)


def test_one_of_each_group_stays(stages):
    _, before, after = stages[1]
    rows = [(r["doc_id"], r["text"]) for r in before.collect()]
    assert ids(after) == sorted(k for k, (_, c) in brute(rows, 5, Fraction(8, 10)).items() if k == c)


def test_no_benchmark_passage_is_left(spark, stages):
    _, before, after = stages[2]
    assert contaminated(after, given(spark, SF, "benchmark")).count() == 0
    words = lambda text: " ".join(re.findall(r"\w+", text.lower()))
    items = [f" {words(r['text'])} " for r in given(spark, SF, "benchmark").collect()]
    verbatim = [r["doc_id"] for r in before.collect() if any(i in f" {words(r['text'] or '')} " for i in items)]
    assert not set(verbatim) & set(ids(after)) and set(ids(before)) - set(ids(after)) == set(verbatim)


def test_secrets_are_replaced(stages):
    _, before, after = stages[3]
    assert ids(after) == ids(before)
    texts = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
    for r in before.collect():
        text, n = texts[r["doc_id"]]
        assert text == r["text"] and n == r["n_chars"] if MARK not in text else n == len(text)
        assert not re.search("[0-9a-f]{24}|AKIA[A-Z0-9]{16}", text)


def test_sources_meet_their_targets(stages):
    _, before, after = stages[4]
    rows = after.collect()
    assert set(ids(after)) <= set(ids(before)) and all(1 <= r["copies"] <= 2 for r in rows)
    for source in {r["source"] for r in rows}:
        own = [r for r in rows if r["source"] == source]
        longest = max(len(r["text"].split()) for r in before.where(before["source"] == source).collect())
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= longest


def test_stages_take_nulls_and_empty_tables(spark):
    docs = given(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (10**7, None, None, None, None), (10**7 + 1, "", "en", "s", 0), (None, "a b c", "en", "s", 5)], docs.schema)
    for source in (docs.limit(0), odd):
        now = source
        for _, stage in corpus_pipeline.STAGES:
            now = stored(stage(spark, now, SF), "test")
        assert now.count() <= source.count()


def test_registered_queries(spark):
    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    found = names["pipeline"](spark, SF)
    assert found.count() > 0 and "taken" in found.columns
