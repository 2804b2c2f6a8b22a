"""A text is encoded once, however many columns come of its ids."""

import public_tokenizers
from treelens.llm import bpe_codec


def test_round_trip_encodes_a_text_once(make):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = make(["one two", None, "", "three"]).coalesce(1)
    rows = {r.doc_id: r.n_tokens for r in bpe_codec.round_trip(docs, path).collect()}
    assert sorted(rows) == [0, 1, 2, 3] and rows[1] == rows[2] == 0 < rows[0]
    plan = bpe_codec.round_trip(docs, path)._jdf.queryExecution().executedPlan().toString()
    evaluated = next(line for line in plan.split("\n") if "ArrowEvalPython" in line)
    assert evaluated.count("<lambda>(") == 1, evaluated
