"""The trees see every distinct candidate."""

from demandloom.llm import pii

from .conftest import docs_of


def test_more_candidates_than_a_sample_holds(spark):
    n = 4500
    docs = docs_of(spark, [(i, f"mail u{i}@h{i}.example.com now") for i in range(n)])
    rows = pii.training_rows(docs)
    # each span and its two other ways of writing
    assert rows.where("label = 1 and kind = 'email'").count() == 3 * n
